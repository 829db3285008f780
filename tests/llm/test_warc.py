"""WARC archives: exact round trip, references, broken input."""

import base64
import hashlib

import pytest
import zstandard

from ledgerbrook.llm import warc

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, None, None), (3, "http://a/3\r\nX: y", "<p>one</p>"), (4, "http://a/ü", "é😀" * 4000),
    (5, "http://a/5", ""), (5, "http://a/5", ""), (None, "http://n", "<p>one</p>"), (None, "u", "only unnamed"),
    (None, "u", "only unnamed"), (9, "http://a/9", "WARC/1.1\r\n\r\n" * 50), (-4, "x", "neg"), (-9, "x", "neg"),
]


def by_hand(rows, least=0):
    held, count = {}, {}
    for page, _, html in rows:
        payload = (html or "").encode()
        count[payload] = count.get(payload, 0) + 1
        if page is not None:
            held[payload] = max(page, held.get(payload, page))
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        target = held.get(payload) if count[payload] > 1 and len(payload) >= least else None
        revisit = target is not None and target != page
        out.append((page, len(payload), digest, "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "q", 1) for r in PAGES], "page_id long, url string, html string, payload string, path int")
    out = warc.round_trip(df)
    assert sorted((tuple(r) for r in out.collect()), key=str) == by_hand(PAGES)
    assert out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_least_bytes(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    refers = {(r["page_id"], r["html"]): r["refers_to"] for r in warc.with_references(df, 5).collect()}
    assert refers[5, ""] is None and refers[1, "<p>one</p>"] == 3


def test_archives_hold_whole_payloads(spark):
    rows = [(i, f"http://h/{i}", f"<html><body>{'page text ' * (i % 50)}{i}</body></html>") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    dictionary = warc.train_dictionary(df)
    assert dictionary[:4] == bytes.fromhex("37a430ec")
    manifest = warc.write_archives(warc.with_references(df), dictionary, archive_bytes=2000)
    files = manifest.collect()
    assert len(files) > 4 and sum(f["records"] for f in files) == 300
    found = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(manifest).collect()}
    assert found == {i: html for i, _, html in rows}
    data = open(files[0]["path"].removeprefix("file:"), "rb").read()
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    for broken in (data[:-3], data[:20], data.replace(b"\x28\xb5\x2f\xfd", b"\x00\xb5\x2f\xfd")):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.records(broken))


def test_both_forms_of_the_dictionary():
    dictionary = b"plain dictionary " * 40
    plain = len(dictionary).to_bytes(4, "little")
    head = warc.DICTIONARY_FRAME.to_bytes(4, "little")
    assert warc.read_dictionary(head + plain + dictionary) == (dictionary, 8 + len(dictionary))
    packed = warc.dictionary_frame(dictionary)
    assert warc.read_dictionary(packed) == (dictionary, len(packed))
    assert warc.read_dictionary(b"") == (None, 0)


@pytest.mark.parametrize(
    "old, new",
    [
        (b"WARC/1.1", b"HTTP/1.1"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Type: response\r\n", b""),
        (b"<p>x</p>", b"<p>y</p>"), (b"\r\n\r\n", b"\n\n"),
    ],
)
def test_validation(old, new):
    good = warc.encode_record(1, "http://a", b"<p>x</p>", None)
    assert warc.decode_record(good)["payload"] == b"<p>x</p>"
    with pytest.raises(ValueError):
        warc.decode_record(good.replace(old, new))


def test_long_run_blocks():
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(b"\0" * 1_000_000)
    assert warc.frame_end(frame + b"next", 0) == len(frame)


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
