"""Packing by power-of-two decomposition.

A document of n token ids (its own and one closing id) is cut into pieces whose
lengths are the powers of two of n, largest first, with as many pieces of
``capacity`` as n holds. Pieces of one length form a bucket; each piece is a
sequence of its own, so no sequence crosses documents and, all lengths being
powers of two, none needs padding. ``sequence_id`` counts through the buckets in
order of (length, doc_id, start): equal lengths lie together.

Tokens come from a public vocabulary file whose path is a parameter. Texts are cut
at white space, where the vocabulary's own rules cut too, so words met before are
looked up instead of encoded again; the look-up tables of a worker are bounded and
given up when full, which changes no result.

Defined cases: a null or empty text is the closing id alone: one piece of length
1. Repeated rows are packed each for itself. A null doc_id is kept. Extra columns
are ignored. An empty table gives an empty result. ``capacity`` must be a power of
two.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep, ranked

WORD_TABLE = 700_000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

#: Marks that, closing a word after a letter, are tokens of their own.
_MARKS = b".,!?;:*#$%&"


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Powers of two that add up to ``n``, none above ``capacity``, largest first."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class _Words(dict):
    """Ids of words met before. A new word gives a place that is filled once all new words of the texts are encoded."""

    def __init__(self, older: dict[bytes, bytes]) -> None:
        self.older, self.open = older, {}

    def __missing__(self, word: bytes) -> bytes | bytearray:
        known = self.older.get(word)
        if known is None:
            return self.open.setdefault(word, bytearray())
        self[word] = known
        return known


class WordTokenizer:
    """Token ids of texts as little-endian 32-bit bytes, with a bounded table of words met before.

    A vocabulary with word ends lets words of letters be encoded many at a time:
    their ids are cut apart at the ids that end a word.
    """

    def __init__(self, path: str, limit: int = WORD_TABLE) -> None:
        # one task, one core: threads of the encoder would take those of other tasks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.limit = limit
        # a full table becomes the older one, from which words still in use come back
        self.words = _Words({})
        self.stems: dict[str, bytes] = {}
        self.old_stems: dict[str, bytes] = {}
        self.ends = np.zeros(self.encoder.get_vocab_size(), bool)
        self.ends[[i for token, i in self.encoder.get_vocab().items() if token.endswith("</w>")]] = True

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.encoder.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def _learn(self, stems: list[str]) -> None:
        letters = [s for s in stems if s.isalpha()]
        parts = [letters[at : at + 512] for at in range(0, len(letters), 512)]
        joined = self.encoder.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, found in zip(parts, joined, strict=True):
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                own = self._encoded(part)
            else:
                raw, stops = ids.tobytes(), (4 * cuts).tolist()
                own = [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
            self.stems.update(zip(part, own, strict=True))
        rest = [s for s in stems if not s.isalpha()]
        self.stems.update(zip(rest, self._encoded(rest), strict=True))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts, one run of bytes each."""
        if len(self.words) > self.limit or len(self.stems) > self.limit:
            self.words.older = {}
            self.words, self.old_stems, self.stems = _Words(self.words), self.stems, {}
        words = self.words
        words.open = {}  # an error in the last call may have left places
        # splits at ASCII white space only, where the vocabulary's own rules cut too; each word is looked up once
        found = [list(map(words.__getitem__, t.split())) for t in texts]
        if words.open:
            parts = {w: _stem_and_tail(w) for w in words.open}
            stems = {x for both in parts.values() for x in both}
            self.stems.update((s, self.old_stems[s]) for s in stems if s in self.old_stems)
            self._learn([s for s in stems if s not in self.stems])
            for word, (stem, tail) in parts.items():
                ids = self.stems[stem] + self.stems[tail]
                words.open[word].extend(ids)
                words[word] = ids
            words.open = {}
        return list(map(b"".join, found))


def _stem_and_tail(word: bytes) -> tuple[str, str]:
    """A word as letters and closing marks, which the vocabulary never joins, or the word and nothing."""
    ascii_stem = word.rstrip(_MARKS)
    if ascii_stem.isalpha():
        return ascii_stem.lower().decode(), word[len(ascii_stem) :].decode()
    whole, stem = word.decode(), ascii_stem.decode()
    # the last character must still be a letter after the vocabulary's own normal form and lower case
    if not stem or not unicodedata.normalize("NFC", stem[-1]).lower()[-1:].isalpha():
        return whole, ""
    return stem, whole[len(stem) :]


@lru_cache(maxsize=1)
def _tokenizer(path: str, limit: int) -> WordTokenizer:
    """One table for all tasks that a Python worker runs."""
    return WordTokenizer(path, limit)


def _pieces(path: str, closing: int, capacity: int, words: int):
    end = int(closing).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path, words)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns: list[list] = [[], [], [], [], []]
                texts = part.column(1).cast(pa.binary()).fill_null(b"").to_pylist()
                for doc, ids in zip(part.column(0).to_pylist(), tokenizer(texts), strict=True):
                    ids += end
                    total, start = len(ids) // 4, 0
                    for length in piece_lengths(total, capacity):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        for column, value in zip(columns, (doc, start, length, crc, total), strict=True):
                            column.append(value)
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return run


def pack(docs: DataFrame, path: str, closing: int = 1, capacity: int = 2048, words: int = WORD_TABLE) -> DataFrame:
    """Pieces of the documents (doc_id, text) with the sequence that each one fills.

    Columns: doc_id, start (ids of its document before it), length, ids_crc32,
    doc_tokens, sequence_id, offset. ``words`` bounds the words that a worker remembers the ids of; the
    result does not depend on it.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(path, closing, capacity, words), PIECE)
    order = [F.col(c) for c in ("length", "doc_id", "start", "ids_crc32", "doc_tokens")]
    return ranked(keep(pieces, "pieces"), order, "sequence_id").withColumn("offset", F.lit(0).cast("long"))
