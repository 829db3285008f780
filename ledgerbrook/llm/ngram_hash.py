"""Checksums of all word runs of a text from the running checksums of its prefixes.

A text is normalised to its words joined by one space and scanned once; the CRC-32 of
the prefix before and after each word is stored. With ``crc(AB) = shift(crc(A), |B|) ^
crc(B)``, where ``shift`` multiplies by x^8 per byte over GF(2), the checksum of any run
of words comes from two prefixes: what the shorter one contributes is shifted by the
length of the run and cancelled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, islice
from zlib import crc32

import numpy as np

POLYNOMIAL = 0xEDB88320
_ALL = np.uint32(0xFFFFFFFF)
#: Bytes of a text whose words are held as a list at a time.
LOT = 1 << 20


def byte_table(keep_digits: bool) -> bytes:
    """Translation of bytes: A-Z lower-cased, letters, bytes beyond ASCII and, if asked, digits kept, all else a space."""
    out = bytearray(b" " * 256)
    for b in range(256):
        if b >= 0x80 or 0x61 <= b <= 0x7A or (keep_digits and 0x30 <= b <= 0x39):
            out[b] = b
        elif 0x41 <= b <= 0x5A:
            out[b] = b + 32
    return bytes(out)


def word_lots(text: bytes, table: bytes, lot: int = LOT) -> Iterator[list[bytes]]:
    """The words of ``text`` in order, in lists that cover about ``lot`` bytes, whatever its length."""
    at = 0
    while at < len(text):
        end = at + lot
        part = text[at:end].translate(table)
        if end < len(text) and part[-1:] != b" ":
            cut = part.rfind(b" ")
            # a word longer than the lot: take all of it
            while cut < 0 and end < len(text):
                end += lot
                part = text[at:end].translate(table)
                cut = part.find(b" ")
            if cut >= 0:
                part, end = part[:cut], at + cut + 1
        at = end
        yield part.split()


def _step(crc: np.ndarray) -> np.ndarray:
    """One zero byte appended to the linear part."""
    return (crc >> np.uint32(8)) ^ _bytes()[crc & np.uint32(255)]


@cache
def _bytes() -> np.ndarray:
    """The remainder of each byte, by rule."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return crc


@cache
def _power(k: int) -> np.ndarray:
    """The shift by 2^k bytes as four tables, one per byte of a checksum."""
    each = np.arange(256, dtype=np.uint32)
    parts = np.stack([each << np.uint32(8 * j) for j in range(4)])
    return _step(parts) if k == 0 else _apply(_power(k - 1), _apply(_power(k - 1), parts))


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    return (
        tables[0][crc & low]
        ^ tables[1][(crc >> np.uint32(8)) & low]
        ^ tables[2][(crc >> np.uint32(16)) & low]
        ^ tables[3][crc >> np.uint32(24)]
    )


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``crc`` as it stands in the checksum of a text that goes on for ``length`` more bytes."""
    out = crc.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        bit = (length >> k) & 1 == 1
        out[bit] = _apply(_power(k), out[bit])
    return out


def _after_space(crc: np.ndarray) -> np.ndarray:
    raw = crc ^ _ALL
    return ((raw >> np.uint32(8)) ^ _bytes()[(raw ^ np.uint32(0x20)) & np.uint32(255)]) ^ _ALL


class Scan:
    """Running checksums and places of the words of texts, each text scanned once."""

    def __init__(self, texts: list[bytes], table: bytes) -> None:
        ends, lengths, counts = [], [], []
        for text in texts:
            crc, n = 0, 0
            for words in word_lots(text, table):
                if not words:
                    continue
                first = crc32(words[0], crc32(b" ", crc) if n else 0)
                run = accumulate(islice(words, 1, None), lambda c, w: crc32(w, crc32(b" ", c)), initial=first)
                ends.append(np.fromiter(run, np.uint32, len(words)))
                lengths.append(np.fromiter(map(len, words), np.int64, len(words)))
                crc, n = int(ends[-1][-1]), n + len(words)
            counts.append(n)
        #: words per text
        self.counts = np.array(counts, np.int64)
        self.ends = np.concatenate(ends) if ends else np.zeros(0, np.uint32)
        size = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        self.text = np.repeat(np.arange(len(counts)), self.counts)
        first = np.ones(len(size), bool)
        first[1:] = self.text[1:] != self.text[:-1]
        self.starts = np.zeros_like(self.ends)
        self.starts[1:] = np.where(first[1:], np.uint32(0), _after_space(self.ends[:-1]))
        # places in the normalised texts laid one after another; only differences within a text are used
        self.stop = np.cumsum(size + 1) - 1
        self.start = self.stop - size

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The text and the checksum of every run of ``n`` words, joined by one space, in text order."""
        count = max(len(self.ends) - n + 1, 0)
        head, tail = slice(0, count), slice(n - 1, n - 1 + count)
        inside = self.text[head] == self.text[tail] if count else np.zeros(0, bool)
        before, after = self.starts[head][inside], self.ends[tail][inside]
        length = (self.stop[tail] - self.start[head])[inside]
        return self.text[head][inside], after ^ shift(before, length)
