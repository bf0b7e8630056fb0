"""Office files and links, without a session."""

import io
import zipfile

import pytest

from millrace.sources import office, web


def packed(files):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as file:
        for name, text in files.items():
            file.writestr(name, text)
    return buffer.getvalue()


def test_office_files():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda x: f"<w:tc><w:p><w:r><w:t>{x}</w:t></w:r></w:p></w:tc>"
    word = packed({"word/document.xml": f"<w:document {w}><w:body><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:tbl><w:tr>{cell('a')}{cell('b')}</w:tr></w:tbl></w:body></w:document>"})
    assert office.zipped_text(word) == "Hello\na | b"
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = packed({
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="One" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}"><si><t>name</t></si></sst>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData><row><c t="s"><v>0</v></c><c><v>7</v></c><c/></row><row><c/></row></sheetData></worksheet>',
    })
    assert office.zipped_text(sheet) == "[One]\nname | 7"
    with pytest.raises(ValueError):
        office.zipped_text(packed({"x": "y"}))
    old = b"\xd0\xcf\x11\xe0\x00\x01some words\x00\x01" + "WordDocument".encode("utf-16-le")
    assert "some words" in office.ole_text(old) and office.ole_kind(old) == "word" and office.ole_kind(b"x") == "unknown"


def test_links():
    pages = {
        "http://a/1": (302, "", "/2", b""),
        "http://a/2": (200, "text/html", None, b'<META http-equiv="refresh" content="0; url=http://b/sheets">'),
        "http://b/sheets": (200, "text/html", None, b"<script>window.location.href = '/last'</script>"),
        "http://b/last": (200, "text/plain", None, b"done"),
        "http://c/loop": (301, "", "http://c/loop", b""),
        "http://d/none": (404, "", None, b""),
    }
    assert web.follow("http://a/1", pages.get) == ("http://b/last", "text/plain", b"done")
    for bad in ("http://c/loop", "http://d/none"):
        with pytest.raises(ValueError):
            web.follow(bad, pages.get)
    assert web.direct("https://drive.google.com/file/d/AbC/view") == "https://drive.google.com/uc?export=download&id=AbC"
    assert web.direct("https://1drv.ms/x/abc") == "https://1drv.ms/x/abc?download=1" and web.direct("http://x/y") == "http://x/y"


def test_links_of_pages_of_any_length_and_kind():
    pad = b"<p>" + b"x" * 50_000 + b"</p>"
    page = lambda body: (200, "text/html", None, body)
    pages = {
        "http://a/1": page(pad + b"<script>location.replace('/2')</script>"), "http://a/2": page(b"<script>window.open(\"http://b.talent.example/p?a=1&amp;b=2\")</script>"),
        "http://b.talent.example/p?a=1&b=2": page(b"<a class='sheet' href='/sheet.xlsx'>sheet</a><script>location.href = '/elsewhere'</script>"), "http://b.talent.example/sheet.xlsx": (200, "application/x", None, b"done"),
        "http://c/1": page(b"<script>document.location = 'http://c/1'</script>text"),
    }
    assert web.follow("http://a/1", pages.get, links={"talent.example": "class='sheet' href='([^']+)'"})[2] == b"done"
    assert web.follow("http://c/1", pages.get)[0] == "http://c/1"
