"""Text of old binary Word and Excel files: the streams of a compound file, Word's piece table, Excel's records."""

from __future__ import annotations

import struct

class Encrypted(ValueError):
    """The file can't be read without a password."""


FREE = 0xFFFFFFFA  # sectors from here on are marks


def streams(data: bytes) -> dict[str, bytes]:
    """The streams of a compound file by name."""
    if data[:8] != b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
        raise ValueError("no compound file")
    size, small = 1 << struct.unpack_from("<H", data, 30)[0], 1 << struct.unpack_from("<H", data, 32)[0]
    n_fat, first, _, limit, mini_first = struct.unpack_from("<IIIII", data, 44)
    more = struct.unpack_from("<I", data, 68)[0]
    sector = lambda i: data[(i + 1) * size : (i + 2) * size]
    ints = lambda b: struct.unpack(f"<{len(b) // 4}I", b[: len(b) // 4 * 4])
    blocks = [x for x in struct.unpack_from("<109I", data, 76) if x < FREE]
    while more < FREE and len(blocks) < n_fat:
        part = ints(sector(more))
        blocks, more = blocks + [x for x in part[:-1] if x < FREE], part[-1]
    fat = [x for b in blocks[:n_fat] for x in ints(sector(b))]

    def chain(at: int, table) -> list[int]:
        out = []
        while at < len(table) and len(out) <= len(table):
            out.append(at)
            at = table[at]
        return out

    read = lambda at: b"".join(sector(i) for i in chain(at, fat))
    entries, found = read(first), {}
    root = next((entries[i : i + 128] for i in range(0, len(entries) - 127, 128) if entries[i + 66] == 5), None)
    if root is None:
        raise ValueError("a compound file without a root")
    inner, mini = read(struct.unpack_from("<I", root, 116)[0]), ints(read(mini_first)) if mini_first < FREE else ()
    for i in range(0, len(entries) - 127, 128):
        entry = entries[i : i + 128]
        length = struct.unpack_from("<H", entry, 64)[0]
        if entry[66] != 2 or not 2 <= length <= 64:
            continue
        start, total = struct.unpack_from("<II", entry, 116)
        body = read(start) if total >= limit else b"".join(inner[k * small : (k + 1) * small] for k in chain(start, mini))
        found.setdefault(entry[: length - 2].decode("utf-16-le", "replace"), body[:total])
    return found


def word_text(found: dict[str, bytes]) -> str:
    """The main text by the piece table: paragraphs as lines, cells behind tabs, fields by their results."""
    main = found["WordDocument"]
    flags, count = struct.unpack_from("<H", main, 10)[0], struct.unpack_from("<I", main, 0x4C)[0]
    if flags & 0x100:
        raise Encrypted("the file is encrypted")
    table = found["1Table" if flags & 0x200 else "0Table"]
    start, size = struct.unpack_from("<II", main, 0x1A2)
    pieces, at = table[start : start + size], 0
    while at < len(pieces) and pieces[at] == 1:  # properties before the table
        at += 3 + struct.unpack_from("<H", pieces, at + 1)[0]
    if at >= len(pieces) or pieces[at] != 2:
        raise ValueError("no piece table")
    size = struct.unpack_from("<I", pieces, at + 1)[0]
    n, at = (size - 4) // 12, at + 5
    places = struct.unpack_from(f"<{n + 1}I", pieces, at)
    out = []
    for i in range(n):
        where = struct.unpack_from("<I", pieces, at + 4 * (n + 1) + 8 * i + 2)[0]
        letters = places[i + 1] - places[i]
        if where & 0x40000000:
            begin = (where & 0x3FFFFFFF) // 2
            out.append(main[begin : begin + letters].decode("cp1252", "replace"))
        else:
            out.append(main[where : where + 2 * letters].decode("utf-16-le", "replace"))
    plain, keep = [], []
    for c in "".join(out)[:count]:
        if c == "\x13":  # a field: its code, then \x14 and its result, then \x15
            keep.append(False)
        elif c == "\x14" and keep:
            keep[-1] = True
        elif c == "\x15" and keep:
            keep.pop()
        elif all(keep):
            plain.append({"\r": "\n", "\x07": "\t", "\x0b": "\n", "\x0c": "\n"}.get(c, c if c >= " " or c == "\t" else ""))
    return "\n".join(x.strip() for x in "".join(plain).split("\n") if x.strip())


class Strings:
    """The shared strings, which go on over several records; a string that is cut has a new flag behind the cut."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.part, self.at = parts, 0, 8

    def take(self, n: int) -> bytes:
        out = b""
        while len(out) < n and self.part < len(self.parts):
            more = self.parts[self.part][self.at : self.at + n - len(out)]
            out, self.at = out + more, self.at + len(more)
            if len(out) < n:
                self.part, self.at = self.part + 1, 0
        return out

    def letters(self, n: int, wide: int) -> str:
        out = []
        while n > 0 and self.part < len(self.parts):
            left = len(self.parts[self.part]) - self.at
            if not left:
                self.part, self.at = self.part + 1, 0
                wide = self.take(1)[0] & 1 if self.part < len(self.parts) else 0
                continue
            here = min(n, left // (2 if wide else 1))
            out.append(self.take(here * (2 if wide else 1)).decode("utf-16-le" if wide else "latin-1", "replace"))
            n -= here
        return "".join(out)

    def all(self) -> list[str]:
        total, out = struct.unpack_from("<I", self.parts[0], 4)[0], []
        while len(out) < total and (head := self.take(3)) and len(head) == 3:
            n, flags = struct.unpack("<HB", head)
            runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
            extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
            out.append(self.letters(n, flags & 1))
            self.take(4 * runs + extra)
        return out


def _number(value: float) -> str:
    return str(int(value)) if value == int(value) and abs(value) < 1e15 else repr(value)


def _rk(raw: int) -> float:
    value = float(struct.unpack("<i", struct.pack("<I", raw & 0xFFFFFFFC))[0] >> 2) if raw & 2 else struct.unpack("<d", struct.pack("<Q", (raw & 0xFFFFFFFC) << 32))[0]
    return value / 100 if raw & 1 else value


def excel_text(found: dict[str, bytes]) -> str:
    """For each sheet a header line and its rows, cells that aren't empty joined with a bar."""
    book = found.get("Workbook", found.get("Book", b""))
    sheets, shared, cells, at, current, formula, strings = [], [], {}, 0, None, None, []

    def short(body: bytes, at: int) -> str:
        n, flags = struct.unpack_from("<HB", body, at)
        return body[at + 3 : at + 3 + n * (2 if flags & 1 else 1)].decode("utf-16-le" if flags & 1 else "latin-1", "replace")

    while at + 4 <= len(book):
        kind, size = struct.unpack_from("<HH", book, at)
        begin, body = at, book[at + 4 : at + 4 + size]
        at += 4 + size
        if strings and kind != 0x3C:
            shared, strings = Strings(strings).all(), []
        if kind == 0x2F:
            raise Encrypted("the file is encrypted")
        if kind == 0x85:
            n, flags = body[6], body[7]
            sheets.append((struct.unpack_from("<I", body)[0], body[8 : 8 + n * (2 if flags & 1 else 1)].decode("utf-16-le" if flags & 1 else "latin-1", "replace")))
        elif kind == 0xFC or (kind == 0x3C and strings):
            strings.append(body)
        elif kind == 0x809:
            current = begin
        elif kind in (0xFD, 0x203, 0x27E, 0x204, 0x06, 0xBD) and size >= 6:
            row, column = struct.unpack_from("<HH", body)
            put = lambda c, value, row=row: cells.setdefault(current, {}).setdefault(row, {}).__setitem__(c, value)
            if kind == 0xFD:
                number = struct.unpack_from("<I", body, 6)[0]
                put(column, shared[number] if number < len(shared) else "")
            elif kind == 0x203:
                put(column, _number(struct.unpack_from("<d", body, 6)[0]))
            elif kind == 0x27E:
                put(column, _number(_rk(struct.unpack_from("<I", body, 6)[0])))
            elif kind == 0x204:
                put(column, short(body, 6))
            elif kind == 0xBD:
                for i in range((size - 6) // 6):
                    put(column + i, _number(_rk(struct.unpack_from("<I", body, 6 + 6 * i)[0])))
            elif body[12:14] == b"\xff\xff":
                formula = (put, column) if body[6] == 0 else None
            else:
                put(column, _number(struct.unpack_from("<d", body, 6)[0]))
        elif kind == 0x207 and formula:
            formula[0](formula[1], short(body, 0))
            formula = None
    out = []
    for place, name in sheets:
        out.append(f"[{name}]")
        for _, row in sorted(cells.get(place, {}).items()):
            line = " | ".join(v.strip() for _, v in sorted(row.items()) if v.strip())
            out += [line] if line else []
    return "\n".join(out)


def ole_text(data: bytes) -> str:
    found = streams(data)
    if "WordDocument" in found:
        return word_text(found)
    if "Workbook" in found or "Book" in found:
        return excel_text(found)
    raise ValueError("neither a document nor a spreadsheet")
