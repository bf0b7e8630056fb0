"""Text of PDF files: what their pages show by text operators, in the order of the file's instructions.

A small reader: objects and object streams, Flate, fonts with a map to Unicode. It gives no layout; encrypted files, and
streams in other encodings, are errors."""

from __future__ import annotations

import re
import zlib

WHITE, DELIMITER = b" \t\r\n\f\0", b"()<>[]{}/%"
TOKEN = re.compile(rb"[^\s\0()<>\[\]{}/%]+")
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Name(str):
    """A name, such as /Type."""


class Op(bytes):
    """An operator; strings are plain bytes."""


class Ref(int):
    """The number of an object."""


class Reader:
    """Values from bytes, one after another."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def skip(self) -> None:
        while self.at < len(self.data):
            if self.data[self.at] in WHITE:
                self.at += 1
            elif self.data[self.at : self.at + 1] == b"%":
                end = re.compile(rb"[\r\n]").search(self.data, self.at)
                self.at = end.end() if end else len(self.data)
            else:
                return

    def literal(self) -> bytes:
        out, depth = [], 1
        self.at += 1
        while depth and self.at < len(self.data):
            c = self.data[self.at : self.at + 1]
            self.at += 1
            if c == b"\\":
                octal = re.compile(rb"[0-7]{1,3}").match(self.data, self.at)
                c = self.data[self.at : self.at + 1]
                if octal:
                    self.at = octal.end()
                    out.append(bytes([int(octal[0], 8) & 255]))
                else:
                    self.at += 1
                    out.append(b"" if c in b"\r\n" else ESCAPES.get(c, c))
                continue
            depth += (c == b"(") - (c == b")")
            if depth:
                out.append(c)
        return b"".join(out)

    def value(self):
        """A value or an operator; None at the end, and at a closing bracket, which is passed."""
        self.skip()
        two, one = self.data[self.at : self.at + 2], self.data[self.at : self.at + 1]
        if not one:
            return None
        if two == b"<<":
            self.at += 2
            items = list(iter(self.value, None))
            return {k: v for k, v in zip(items[::2], items[1::2], strict=False) if isinstance(k, Name)}
        if one == b"[":
            self.at += 1
            return list(iter(self.value, None))
        if one == b"(":
            return self.literal()
        if one == b"<":
            end = self.data.find(b">", self.at)
            digits = re.sub(rb"\s", b"", self.data[self.at + 1 : end if end >= 0 else len(self.data)])
            self.at = end + 1 if end >= 0 else len(self.data)
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode("ascii", "replace"))
        if one in b">]}{":
            self.at += 2 if two == b">>" else 1
            return None
        if one == b"/":
            found = TOKEN.match(self.data, self.at + 1)
            self.at = found.end() if found else self.at + 1
            return Name(found[0].decode("latin-1") if found else "")
        found = TOKEN.match(self.data, self.at)
        self.at = found.end() if found else self.at + 1
        word = found[0] if found else one
        if re.fullmatch(rb"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)", word):
            ref = re.compile(rb"\s+[0-9]+\s+R(?![A-Za-z])").match(self.data, self.at) if word.isdigit() else None
            if ref:
                self.at = ref.end()
                return Ref(word)
            return float(word)
        return Op(word)


class File:
    def __init__(self, data: bytes):
        if re.search(rb"/Encrypt\s+[0-9]+\s+[0-9]+\s+R|/Encrypt\s*<<", data):
            raise ValueError("the file is encrypted")
        self.objects: dict[int, tuple[object, bytes | None]] = {}
        for start in re.finditer(rb"(?<![0-9])([0-9]+)\s+[0-9]+\s+obj\b", data):
            reader = Reader(data, start.end())
            value, body = reader.value(), None
            stream = re.compile(rb"\s*stream\r?\n").match(data, reader.at)
            if stream and isinstance(value, dict):
                size = value.get("Length")
                end = stream.end() + int(size) if isinstance(size, float) else -1
                if not re.compile(rb"\s*endstream").match(data, end) if end >= 0 else True:
                    end = data.find(b"endstream", stream.end())
                body = data[stream.end() : end if end >= 0 else len(data)]
            self.objects[int(start[1])] = (value, body)
        for value, body in list(self.objects.values()):
            if isinstance(value, dict) and value.get("Type") == "ObjStm" and body is not None:
                plain, first = self.inflated(value, body), int(value["First"])
                numbers = [int(x) for x in plain[:first].split()]
                for number, at in zip(numbers[::2], numbers[1::2], strict=True):
                    self.objects.setdefault(number, (Reader(plain, first + at).value(), None))

    def get(self, value):
        seen = 0
        while isinstance(value, Ref) and seen < 32:
            value, seen = self.objects.get(int(value), (None, None))[0], seen + 1
        return value

    def inflated(self, value: dict, body: bytes) -> bytes:
        filters = self.get(value.get("Filter"))
        for name in filters if isinstance(filters, list) else [filters] if filters else []:
            if name != "FlateDecode":
                raise ValueError(f"a stream in {name}")
            body = zlib.decompressobj().decompress(body)
        return body

    def stream(self, value) -> bytes:
        held = self.objects.get(int(value), (None, None)) if isinstance(value, Ref) else (None, None)
        return self.inflated(held[0], held[1]) if held[1] is not None else b""

    def pages(self):
        """(page, its resources) in their order."""
        root = next((v for v, _ in self.objects.values() if isinstance(v, dict) and v.get("Type") == "Catalog"), {})
        stack, seen = [(root.get("Pages"), {})], set()
        while stack:
            at, inherited = stack.pop()
            node = self.get(at)
            if not isinstance(node, dict) or (isinstance(at, Ref) and at in seen):
                continue
            seen.add(at if isinstance(at, Ref) else id(node))
            resources = self.get(node.get("Resources")) or inherited
            kids = self.get(node.get("Kids"))
            if isinstance(kids, list):
                stack += [(k, resources) for k in reversed(kids)]
            else:
                yield node, resources

    def letters(self, font) -> tuple[int, dict[int, str]] | None:
        """Bytes of a code and the letters of codes, from a font's map to Unicode."""
        font = self.get(font)
        if not isinstance(font, dict) or not isinstance(font.get("ToUnicode"), Ref):
            return None
        reader, out, width, held = Reader(self.stream(font["ToUnicode"])), {}, 1, []
        text = lambda b: b.decode("utf-16-be", "replace")
        while reader.at < len(reader.data):
            value = reader.value()
            if isinstance(value, Op) and not value.startswith(b"endbf"):
                held = []
            elif isinstance(value, Op) and value == b"endbfchar":
                for code, to in zip(held[::2], held[1::2], strict=False):
                    out[int.from_bytes(code)], width = text(to), len(code)
            elif isinstance(value, Op):
                for low, high, to in zip(held[::3], held[1::3], held[2::3], strict=False):
                    width = len(low)
                    most = min(int.from_bytes(high) - int.from_bytes(low), 65_535)
                    for i in range(most + 1):
                        if isinstance(to, list):
                            out[int.from_bytes(low) + i] = text(to[i]) if i < len(to) else ""
                        else:  # the last unit of the letters counts up
                            out[int.from_bytes(low) + i] = text(to[:-2] + (int.from_bytes(to[-2:]) + i & 0xFFFF).to_bytes(2))
            elif isinstance(value, (bytes, list)):
                held.append(value)
        return width, out


def shown(file: File, page: dict, resources: dict) -> str:
    """What a page shows: a new line wherever text is placed anew, a blank for a wide gap in a line."""
    inner = file.get(page.get("Contents"))
    parts = inner if isinstance(inner, list) else [page.get("Contents")]
    fonts = file.get(resources.get("Font")) or {}
    reader, held, font, out, known = Reader(b"\n".join(file.stream(p) for p in parts)), [], None, [], {}

    def said(data: bytes) -> str:
        if font is None:
            return data.decode("cp1252", "replace")
        width, letters = font
        return "".join(letters.get(int.from_bytes(data[i : i + width]), "") for i in range(0, len(data), width))

    while reader.at < len(reader.data):
        value = reader.value()
        if not isinstance(value, Op):
            held.append(value)
            continue
        if value == b"Tf" and len(held) > 1:
            name = held[-2]
            known.setdefault(name, file.letters(fonts.get(name)))
            font = known[name]
        elif value in (b"T*", b"Tm", b"ET") or (value in (b"Td", b"TD") and len(held) > 1 and held[-1]):
            out.append("\n")
        elif value in (b"Tj", b"'", b'"') and held and isinstance(held[-1], bytes):
            out.append(("" if value == b"Tj" else "\n") + said(held[-1]))
        elif value == b"TJ" and held and isinstance(held[-1], list):
            out += [said(x) if isinstance(x, bytes) else " " if isinstance(x, float) and x < -200 else "" for x in held[-1]]
        elif value == b"ID":  # an image within the page
            end = re.compile(rb"\sEI(?=\s|$)").search(reader.data, reader.at)
            reader.at = end.end() if end else len(reader.data)
        held = []
    return "\n".join(x.strip() for x in "".join(out).split("\n") if x.strip())


def pdf_text(data: bytes) -> str:
    """The pages' texts, joined by newlines."""
    file = File(data)
    return "\n".join(x for x in (shown(file, *page) for page in file.pages()) if x)
