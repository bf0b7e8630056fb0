"""PDF and old office files that the tests put together themselves."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.sources import documents, office, ole, pdf


def pdf_file(objects, extra=b""):
    out = b"%PDF-1.5\n"
    for number, (head, body) in objects.items():
        out += b"%d 0 obj\n" % number + head
        if body is not None:
            out += b"\nstream\n" + body + b"\nendstream"
        out += b"\nendobj\n"
    return out + b"trailer << /Root 1 0 R " + extra + b">>\n%%EOF"


CMAP = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <6771> <0002> <4EAC> endbfchar 1 beginbfrange <0010> <0012> <0041> endbfrange"


def sample(extra=b""):
    first = zlib.compress(rb"BT /F1 12 Tf 10 700 Td (Hello \(PDF\) \101) Tj 0 -14 Td [(wi) -20 (de) -400 (gap)] TJ T* (caf\351) ' ET")
    second = zlib.compress(b"q BI /W 1 ID \x00(\xff EI Q BT /F2 9 Tf <00010002> Tj 0 -9 Td <001000110012> Tj ET")
    first_at = len(b"7 0 8 52 ")
    inner = b"7 0 8 52 " + b"<< /Type /Page /Parent 2 0 R /Contents 4 0 R >>".ljust(52) + b"<< /Type /Font /ToUnicode 9 0 R >>"
    packed = zlib.compress(inner)
    return pdf_file({
        1: (b"<< /Type /Catalog /Pages 2 0 R >>", None), 2: (b"<< /Type /Pages /Kids [3 0 R 7 0 R] /Count 2 /Resources << /Font << /F1 10 0 R /F2 8 0 R >> >> >>", None),
        3: (b"<< /Type /Page /Parent 2 0 R /Contents [5 0 R] >>", None), 4: (b"<< /Length %d /Filter /FlateDecode >>" % len(second), second), 5: (b"<< /Length 11 0 R /Filter [/FlateDecode] >>", first),
        6: (b"<< /Type /ObjStm /N 2 /First %d /Length %d /Filter /FlateDecode >>" % (first_at, len(packed)), packed), 9: (b"<< /Length %d >>" % len(CMAP), CMAP), 10: (b"<< /Type /Font >>", None),
    }, extra)


def test_pdf():
    assert pdf.pdf_text(sample()) == "Hello (PDF) A\nwide gap\ncafé\n東京\nABC"
    with pytest.raises(ValueError, match="encrypted"):
        pdf.pdf_text(sample(b"/Encrypt 12 0 R "))
    with pytest.raises(ValueError, match="DCTDecode"):
        pdf.pdf_text(pdf_file({1: (b"<</Type/Catalog/Pages 2 0 R>>", None), 2: (b"<</Type/Pages/Kids[3 0 R]>>", None), 3: (b"<</Type/Page/Contents 4 0 R>>", None), 4: (b"<</Length 1/Filter/DCTDecode>>", b"x")}))
    assert pdf.pdf_text(b"%PDF-1.4 broken (") == ""


def compound(named):
    """A compound file: streams of less than 4,096 bytes in the small sectors, others in large ones."""
    size, sectors, fat = 512, [], []

    def put(data):
        data += b"\0" * (-len(data) % size)
        n = len(data) // size
        at = len(sectors)
        sectors.extend(data[i * size : (i + 1) * size] for i in range(n))
        fat.extend([*range(at + 1, at + n), 0xFFFFFFFE] if n else [])
        return at if n else 0xFFFFFFFE

    inner, mini, entries = b"", [], []
    for name, data in named.items():
        if len(data) >= 4096:
            entries.append((name, 2, put(data), len(data)))
        else:
            n, at = -(-len(data) // 64), len(mini)
            mini += [*range(at + 1, at + n), 0xFFFFFFFE] if n else []
            inner += data + b"\0" * (-len(data) % 64)
            entries.append((name, 2, at, len(data)))
    root = ("Root Entry", 5, put(inner), len(inner))
    mini_at = put(struct.pack(f"<{len(mini)}I", *mini) + b"\xff" * (-4 * len(mini) % size)) if mini else 0xFFFFFFFE
    folder = b""
    for name, kind, at, length in [root, *entries]:
        text = name.encode("utf-16-le") + b"\0\0"
        folder += (text.ljust(64, b"\0") + struct.pack("<HBB", len(text), kind, 1) + b"\xff" * 12).ljust(116, b"\0") + struct.pack("<IQ", at, length)
    folder_at = put(folder)
    fat_at = len(sectors)
    table = [*fat, 0xFFFFFFFD]
    sectors.append(struct.pack(f"<{len(table)}I", *table) + b"\xff" * (size - 4 * len(table)))
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 10
    head += struct.pack("<IIIIIIII", 1, folder_at, 0, 4096, mini_at, 1, 0xFFFFFFFE, 0) + struct.pack("<109I", fat_at, *[0xFFFFFFFF] * 108)
    return head + b"".join(sectors)


def word(text, flags=0x200, big=False):
    plain, wide = text[:5], text[5:]
    body = bytearray(0x400)
    struct.pack_into("<H", body, 10, flags)
    struct.pack_into("<I", body, 0x4C, len(text))
    first, second = len(body), len(body) + len(plain)
    body += plain.encode("cp1252") + wide.encode("utf-16-le") + (b"\0" * 5000 if big else b"")
    pieces = struct.pack("<III", 0, len(plain), len(text)) + struct.pack("<HIH", 0, 2 * first | 0x40000000, 0) + struct.pack("<HIH", 0, second, 0)
    clx = b"\1\2\0ab" + b"\2" + struct.pack("<I", len(pieces)) + pieces
    struct.pack_into("<II", body, 0x1A2, 7, len(clx))
    return compound({"WordDocument": bytes(body), "1Table": b"\0" * 7 + clx})


def record(kind, body):
    return struct.pack("<HH", kind, len(body)) + body


def excel():
    first = "東京 office".encode("utf-16-le")
    shared = struct.pack("<IIHB", 2, 2, 9, 1) + first[:6]  # the first string goes on in the next record
    rest = b"\1" + first[6:] + struct.pack("<HB", 4, 0) + b"name"
    rows = record(0x809, b"\0" * 8) + record(0xFD, struct.pack("<HHHI", 0, 0, 0, 1)) + record(0xFD, struct.pack("<HHHI", 0, 2, 0, 0)) + record(0x203, struct.pack("<HHHd", 1, 0, 0, 2.5))
    rows += record(0xBD, struct.pack("<HH", 2, 0) + struct.pack("<HIHI", 0, 700 << 2 | 3, 0, 40 << 2 | 2) + struct.pack("<H", 1)) + record(0x27E, struct.pack("<HHHI", 3, 0, 0, struct.unpack("<Q", struct.pack("<d", 8.0))[0] >> 32))
    rows += record(0x06, struct.pack("<HHH", 4, 1, 0) + b"\0" + b"\0" * 5 + b"\xff\xff" + b"\0" * 6) + record(0x207, struct.pack("<HB", 3, 0) + b"sum") + record(0x0A, b"")
    globals_ = lambda at: record(0x809, b"\0" * 8) + record(0x85, struct.pack("<I", at) + struct.pack("<HBB", 0, 3, 0) + b"One") + record(0xFC, shared) + record(0x3C, rest) + record(0x0A, b"")
    return compound({"Workbook": globals_(len(globals_(0))) + rows, "pad": b"x" * 5000})


@pytest.mark.parametrize("big", [False, True])
def test_old_documents(big):
    assert ole.ole_text(word("Hallo Wörld\rzwei\x07drei\x07\rsee \x13HYPERLINK x\x14link\x15 東京", big=big)) == "Hallo Wörld\nzwei\tdrei\nsee link 東京"
    with pytest.raises(ValueError, match="encrypted"):
        office.ole_text(word("abcdefg", flags=0x300))


def test_old_sheets():
    assert ole.ole_text(excel()) == "[One]\nname | 東京 office\n2.5\n7 | 40\n8\nsum"


def test_files_become_texts(spark):
    files = [("a.pdf", sample()), ("b.doc", word("some old words")), ("c.xls", excel()), ("d.pdf", sample(b"/Encrypt 12 0 R ")), ("e.HTM", b"<p>x</p>"), ("f.txt", "é".encode()), ("g", b"\xd0\xcf\x11\xe0 broken words"), ("h.pdf", None)]
    df = spark.createDataFrame([(n, bytearray(b) if b is not None else None) for n, b in files], "name string, content binary")
    got = {r["name"]: (r["text"], r["error"]) for r in documents.to_text(df, {**office.PARSERS, "html": lambda b: b.decode().upper()}, name="name").collect()}
    assert got["a.pdf"][0].startswith("Hello") and got["b.doc"] == ("some old words", None) and got["c.xls"][0].startswith("[One]") and got["e.HTM"][0] == "<P>X</P>" and got["f.txt"] == ("é", None)
    assert "encrypted" in got["d.pdf"][1] and "broken words" in got["g"][0] and got["h.pdf"] == (None, "empty")
    assert documents.to_text(df, office.PARSERS).filter(F.col("name") == "e.HTM").first()["text"] == "<p>x</p>"
