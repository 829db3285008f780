"""Packing: exact round trip of ids, piece by piece."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerbrook.llm.common import vocabulary
from ledgerbrook.llm.packing import WordTokenizer, pack, piece_lengths

TEXTS = [
    "", None, " \n ", "one", "The idiot's book, isn't it? <|endoftext|>x", "İ. İstanbul. ΑΣ. a≠. b.̸ क़.",
    "école. ́ x y ß 123, 4a5. ok.' (x). \x1f\x1c a\x85b   c", "word " * 5000, "多 字。 한국어! 😀a😀.", "A" * 3000,
]


def test_ids_equal_those_of_whole_texts():
    path = vocabulary("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = [t for t in TEXTS if t is not None]
    for limit in (400_000, 3, 0):
        own = WordTokenizer(path, limit)
        for text in texts:
            ids = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert own([text.encode()])[0] == ids, text[:40]


def test_each_word_is_looked_up_once():
    class Word(bytes):
        lookups = 0

        def __hash__(self):
            Word.lookups += 1
            return bytes.__hash__(self)

    class Text(bytes):
        def split(self):
            return [Word(w) for w in bytes.split(self)]

    own = WordTokenizer(vocabulary("word_bpe_49k.json"))
    own([b"one two three"])
    first, Word.lookups = Text(b"one two three " * 1000 + b"four"), 0
    assert own([first]) == WordTokenizer(vocabulary("word_bpe_49k.json"))([bytes(first)])
    # a new word makes a text no dearer: some steps for the word itself, one look-up for each of the others
    assert Word.lookups <= 3000 + 20


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 10_000])
def test_lengths(n):
    parts = piece_lengths(n, 2048)
    assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 2048 for p in parts)


def test_pieces_cover_each_document_once(spark):
    path = vocabulary("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = [(i, t, "z", 1) for i, t in enumerate(TEXTS)] + [(3, "one", "z", 1), (None, "two words", "z", 1)]
    out = pack(spark.createDataFrame(rows, "doc_id long, text string, start string, length int"), path).collect()
    by_doc = defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
        assert r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0
    assert sorted(r["sequence_id"] for r in out) == list(range(len(out)))
    in_order = sorted(out, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in in_order] == sorted(r["length"] for r in out)
    for i, text in [*enumerate(TEXTS), (None, "two words")]:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        times = 2 if i == 3 else 1
        at = 0
        for r in pieces[::times]:
            assert (r["start"], r["doc_tokens"]) == (at, len(ids) // 4)
            assert r["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert at == len(ids) // 4 and len(pieces) % times == 0


def test_empty(spark):
    out = pack(spark.createDataFrame([], "doc_id long, text string"), vocabulary("word_bpe_49k.json"))
    assert out.count() == 0
    with pytest.raises(ValueError):
        pack(spark.range(1), "x", capacity=1000)
