"""Spans of pieces against a plain alignment, with the public model and with character maps put into it."""

import hashlib
import random
import struct

import numpy as np
import pytest

from skyledger.llm import charmap, pieces, queries
from skyledger.llm.models import piece_model

FOLDER = "/root/testdata/sf0.001"
MAP = {"ﬁ": "fi", "　": " ", "Ａ": "A", "é": "é", "½": "1 2", "\x07": "", "\t": " ", "abc": "x", "abcd": "yy", "ab": "q", "…": "...", "ſ": "s"}
TEXTS = ["", " ", "  two  blanks ", "Hello world", "ﬁne　Ａ éé ½ cup", "abcd abc ab a", "abababcdab", "tab\there\x07", "日本語 \U0001f600 naïve", "▁mark▁ and ▁",
         "line\nfeed\r\n", "  x", "½½", " …ſ ", "a\x00b", "x" * 3000, "word " * 2000, "ﬁ" * 500, "　　ﬁ　　", "\x07", " \x07 x", "\x07 "]


def compiled(keys):
    """A double array over the keys: children of a node lie at its base with their byte."""

    root: dict = {}
    strings = b""
    for key, value in sorted(keys.items()):
        node = root
        for byte in key.encode():
            node = node.setdefault(byte, {})
        node[0] = len(strings)
        strings += value.encode() + b"\0"
    units, used, bases = {0: 0}, {0}, set()

    def place(index, node):
        base = next(b for b in range(1, 1 << 20) if b not in bases and all((b ^ c) not in used for c in node) and (index ^ b) < 1 << 21)
        bases.add(base)
        used.update(base ^ c for c in node)
        units[index] = units.get(index, 0) | (index ^ base) << 10 | (0 in node) << 8
        for byte, child in node.items():
            if byte == 0:
                units[base] = child | 1 << 31
            else:
                units[base ^ byte] = byte
                place(base ^ byte, child)

    place(0, root)
    size = -(-(max(units) + 1) // 256) * 256
    return struct.pack("<I", 4 * size) + struct.pack(f"<{size}I", *[units.get(i, 1 << 31) for i in range(size)]) + strings


def field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    return varint(number << 3 | 2) + varint(len(value)) + value if isinstance(value, bytes) else varint(number << 3) + varint(value)


def model_with(keys, prefix, squeeze):
    with open(piece_model(), "rb") as file:
        model = file.read()
    kept = [(n, v) for n, v in charmap.proto_fields(model) if n != charmap.NORMALIZER_FIELD]
    spec = (field(2, compiled(keys)) if keys else b"") + field(3, int(prefix)) + field(4, int(squeeze)) + field(5, 1)
    return b"".join(field(n, v) for n, v in kept) + field(charmap.NORMALIZER_FIELD, spec)


def plain_alignment(text, keys, prefix, squeeze):
    """(normalised characters, original byte span of each of their bytes), one key or character after the other."""

    chunks, at = [], 0
    while at < len(text):
        key = max((k for k in keys if text.startswith(k, at)), key=lambda k: len(k.encode()), default=None)
        taken = key or text[at]
        chunks.append((keys[key] if key else taken, len(text[:at].encode()), key is None))
        at += len(taken)
    out, origin = b"", []
    end = len(text.encode())
    if squeeze:
        while chunks and chunks[0][0] == " ":
            chunks.pop(0)
    if not chunks:
        return b"", [end]
    if prefix:
        out, origin = charmap.SPACE_MARK, [chunks[0][1]] * 3
    blank = squeeze
    for piece, place, copied in chunks:
        piece = piece.lstrip(" ") if blank else piece
        if piece:
            raw = piece.encode().replace(b" ", charmap.SPACE_MARK)
            out += raw
            origin += [place + i if copied and piece != " " else place for i in range(len(raw))]
            blank = squeeze and piece.endswith(" ")
    while squeeze and out.endswith(charmap.SPACE_MARK):
        end = origin[-3]
        out, origin = out[:-3], origin[:-3]
    return out, [*origin, end]


@pytest.mark.parametrize("keys", [{}, MAP], ids=["no map", "map"])
@pytest.mark.parametrize("prefix,squeeze", [(True, False), (True, True), (False, False), (False, True)])
def test_spans_equal_a_plain_alignment(keys, prefix, squeeze):
    codec = pieces.PieceCodec(model_with(keys, prefix, squeeze))
    generator = random.Random(3)
    mixed = ["".join(generator.choice([*MAP, " ", "a", "b", "c", "é", "日", "▁", "\U0001f600"]) for _ in range(40)) for _ in range(60)]
    texts = [*TEXTS, *mixed]
    for text, (ids, starts, ends) in zip(texts, codec.encode(texts)):
        normal, origin = plain_alignment(text, keys, prefix, squeeze)
        assert codec.normalizer(text.encode())[0] == normal and codec.normalizer(text.encode())[1].tolist() == origin
        assert ids == codec.library.encode(text, add_eos=True)
        at = 0
        for i, start, end in zip(ids[:-1], starts, ends):
            width = 1 if codec.library.is_byte(i) else len(codec.library.id_to_piece(i).encode())
            assert (start, end) == (origin[at], origin[at + width])
            at += width
        assert at == len(normal) and starts[-1] == ends[-1]


def test_query_spans_tile_the_texts(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    codec = pieces.PieceCodec(open(piece_model(), "rb").read())
    rows = {r.doc_id: r for r in queries.QUERIES["op4_sentencepiece_offsets"](spark, FOLDER).collect()}
    assert set(rows) == set(texts)
    for doc_id, text in texts.items():
        _, starts, ends = next(codec.encode([text]))
        assert rows[doc_id].spans_sha256 == hashlib.sha256(" ".join(map(str, [*starts, *ends])).encode()).hexdigest()
        size = len(text.encode())
        assert starts[0] == 0 and np.array_equal(starts[1:], ends[:-1]) and rows[doc_id].span_bytes == size == ends[-1]
