"""Text of office files with the standard library: zipped XML, and by small readers old binary files and PDF."""

from __future__ import annotations

import io
import re
import struct
import zipfile
from xml.etree import ElementTree

from . import ole, pdf

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _texts(node, tag: str) -> str:
    return "".join(x.text or "" for x in node.iter(tag))


def document_text(data: bytes) -> str:
    """Paragraphs outside of tables, then the tables' rows, cells joined with a bar."""
    with zipfile.ZipFile(io.BytesIO(data)) as file:
        body = ElementTree.fromstring(file.read("word/document.xml")).find(f"{W}body")
    lines = [_texts(p, f"{W}t") for p in body.findall(f"{W}p")]
    for row in body.iter(f"{W}tr"):
        lines.append(" | ".join(x for x in (_texts(c, f"{W}t").strip() for c in row.findall(f"{W}tc")) if x))
    return "\n".join(x for x in lines if x.strip())


def sheet_text(data: bytes) -> str:
    """For each sheet a header line and its rows, cells that aren't empty joined with a bar."""
    with zipfile.ZipFile(io.BytesIO(data)) as file:
        names = set(file.namelist())
        shared = [_texts(x, f"{S}t") for x in ElementTree.fromstring(file.read("xl/sharedStrings.xml")).findall(f"{S}si")] if "xl/sharedStrings.xml" in names else []
        targets = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(file.read("xl/_rels/workbook.xml.rels"))}
        lines = []
        for sheet in ElementTree.fromstring(file.read("xl/workbook.xml")).iter(f"{S}sheet"):
            target = targets[sheet.get(f"{R}id")].lstrip("/")
            rows = ElementTree.fromstring(file.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{S}row")
            lines.append(f"[{sheet.get('name')}]")
            for row in rows:
                cells = [_cell(c, shared) for c in row.findall(f"{S}c")]
                if any(cells):
                    lines.append(" | ".join(x for x in cells if x))
    return "\n".join(lines)


def _cell(cell, shared: list[str]) -> str:
    if cell.get("t") == "inlineStr":
        return _texts(cell, f"{S}t").strip()
    value = cell.find(f"{S}v")
    if value is None or value.text is None:
        return ""
    return (shared[int(value.text)] if cell.get("t") == "s" else value.text).strip()


def zipped_text(data: bytes) -> str:
    """Either of the two, by what the archive holds."""
    with zipfile.ZipFile(io.BytesIO(data)) as file:
        names = set(file.namelist())
    if "word/document.xml" in names:
        return document_text(data)
    if "xl/workbook.xml" in names:
        return sheet_text(data)
    raise ValueError("neither a document nor a spreadsheet")


def printable(data: bytes, least: int = 4) -> str:
    """Runs of printable characters of an old binary file, in UTF-16 and in one byte each; a fallback without its format."""
    wide = [x.decode("utf-16-le") for x in re.findall(rb"(?:[\x20-\x7e\t]\x00|[^\x00-\x1f][\x30-\x9f]){%d,}" % least, data)]
    plain = [x.decode("ascii") for x in re.findall(rb"[\x20-\x7e\t]{%d,}" % least, data)]
    return "\n".join(x for x in dict.fromkeys(y.strip() for y in [*wide, *plain]) if x)


def ole_kind(data: bytes) -> str:
    """Which program an old binary file is of, by the names of its streams: word, excel or unknown."""
    for kind, names in (("word", ("WordDocument",)), ("excel", ("Workbook", "Book"))):
        if any(name.encode("utf-16-le") in data for name in names):
            return kind
    return "unknown"


def ole_text(data: bytes) -> str:
    """The text of an old Word or Excel file; of one whose structure is broken, its printable characters. An
    encrypted one is an error."""
    try:
        return ole.ole_text(data)
    except ole.Encrypted:
        raise
    except (ValueError, struct.error, IndexError, KeyError):
        return printable(data)


PARSERS = {"zip": zipped_text, "ole": ole_text, "pdf": pdf.pdf_text}
