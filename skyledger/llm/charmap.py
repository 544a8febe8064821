"""Normalisation through a compiled character map, with the place each output byte came from.

The map of a tokenizer model is a double-array trie over UTF-8 bytes, followed by
zero-terminated replacement strings. At each position the longest key in the trie is
replaced; without one, a single character is copied.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np

SPACE_MARK = "▁".encode()
#: Field numbers and types in the public model format (fixed values).
PIECE_FIELD, TRAINER_FIELD, NORMALIZER_FIELD, DENORMALIZER_FIELD = 1, 2, 3, 5
USER_DEFINED, BPE = 4, 2


def proto_fields(data: bytes):
    """The (number, value) pairs of one protocol buffer message; nested messages stay bytes."""

    at, end = 0, len(data)

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value, at

    while at < end:
        tag, at = varint(at)
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        yield number, value


class CharMap:
    """The compiled map: ``longest(text, at)`` gives (bytes taken, replacement) or None."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.strings = b""
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.strings = blob[4 + size:]
        self.starts = self._starts()

    def _child(self, base: int, byte: int) -> tuple[int, int] | None:
        """The place and the unit of a child, if there is one."""

        node = base ^ byte
        if node < len(self.units) and self.units[node] & 0x800000FF == byte:
            return node, self.units[node]
        return None

    def _starts(self) -> np.ndarray:
        """``[first, second]``: whether a key may start with these two bytes, or is the first alone."""

        found = np.zeros((256, 256), bool)
        for first in range(1, 256) if self.units else ():
            child = self._child(self._offset(self.units[0]), first)
            if child is not None:
                node, unit = child
                base = node ^ self._offset(unit)
                found[first] = unit >> 8 & 1 or [second > 0 and self._child(base, second) is not None for second in range(256)]
        return found

    def places(self, data: np.ndarray) -> np.ndarray:
        """Where a key may start in a text; everywhere else the text maps to itself."""

        return np.flatnonzero(self.starts[data, np.append(data[1:], np.uint8(0))]) if self.units and len(data) else np.zeros(0, np.int64)

    def __bool__(self) -> bool:
        return bool(self.units)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        units, found = self.units, None
        node = self._offset(units[0])
        for place in range(at, len(text)):
            byte = text[place]
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = place + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        taken, start = found
        return taken, self.strings[start:self.strings.index(b"\0", start)]


@dataclass
class Normalizer:
    """The steps that a model asks for before it splits a text into pieces."""

    map: CharMap = field(default_factory=lambda: CharMap(b""))
    dummy_prefix: bool = True
    squeeze_blanks: bool = True
    mark_blanks: bool = True

    @classmethod
    def from_spec(cls, spec: bytes) -> Normalizer:
        found = dict(proto_fields(spec))
        return cls(CharMap(found.get(2, b"")), bool(found.get(3, 1)), bool(found.get(4, 1)), bool(found.get(5, 1)))

    def _step(self, text: bytes, at: int) -> tuple[int, bytes]:
        if self.map and (hit := self.map.longest(text, at)):
            return hit
        lead = text[at]
        taken = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return taken, text[at:at + taken]

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) its offset in the original bytes.

        Keys are looked for where one may start; stretches between them map to themselves at once, byte by byte. All bytes
        of a replacement lie at the place of its key.
        """

        data = np.frombuffer(text, np.uint8)
        parts, origins, at, replaced = [], [], 0, len(text)
        for place in self.map.places(data).tolist():
            if place < at or (hit := self.map.longest(text, place)) is None:
                continue
            taken, piece = hit
            if self.squeeze_blanks and b" " in piece:
                return self._by_step(text)
            replaced = min(replaced, place)
            parts += [text[at:place], piece]
            origins += [np.arange(at, place), np.full(len(piece), place)]
            at = place + taken
        out = b"".join([*parts, text[at:]])
        origin = np.concatenate([*origins, np.arange(at, len(text))]) if parts else np.arange(len(text))
        lead = 0
        if self.squeeze_blanks:
            # What is skipped at the start, up to the first key.
            lead = min(len(text) - len(text.lstrip(b" ")), replaced)
            blank = np.frombuffer(out, np.uint8) == 32
            kept = np.flatnonzero(~(blank & np.append(True, blank[:-1])))
            out, origin = np.frombuffer(out, np.uint8)[kept].tobytes(), origin[kept]
        if lead == len(text):
            return b"", np.array([len(text)])
        blank = SPACE_MARK if self.mark_blanks else b" "
        width = np.where(np.frombuffer(out, np.uint8) == 32, len(blank), 1)
        first = np.full(len(blank), lead) if self.dummy_prefix else np.zeros(0, np.int64)
        out = (blank if self.dummy_prefix else b"") + out.replace(b" ", blank)
        origin, size = np.concatenate([first, np.repeat(origin, width), [len(text)]]), len(out)
        while self.squeeze_blanks and out.endswith(blank, 0, size):
            size -= len(blank)
        return out[:size], origin[:size + 1]

    def _by_step(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The same, one key or character after the other: where replacements bring blanks of their own."""

        out, origin, at = bytearray(), [], 0
        blank = SPACE_MARK if self.mark_blanks else b" "
        if self.squeeze_blanks:
            while at < len(text):
                taken, piece = self._step(text, at)
                if piece != b" ":
                    break
                at += taken
        if at == len(text):
            return b"", np.array([at])

        def put(piece: bytes, place: int, copied: bool) -> None:
            out.extend(piece)
            origin.extend(range(place, place + len(piece)) if copied else [place] * len(piece))

        if self.dummy_prefix:
            put(blank, at, False)
        after_blank = self.squeeze_blanks
        while at < len(text):
            taken, piece = self._step(text, at)
            if self.squeeze_blanks and after_blank:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", blank), at, piece == text[at:at + taken] and piece != b" ")
                after_blank = self.squeeze_blanks and piece.endswith(b" ")
            at += taken
        end = at
        if self.squeeze_blanks:
            while out.endswith(blank):
                end = origin[len(out) - len(blank)]
                del out[-len(blank):], origin[-len(blank):]
        return bytes(out), np.array([*origin, end])
