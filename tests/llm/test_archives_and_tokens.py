"""WARC round trips and the encoder against the tokenizers library."""

import hashlib
import io
import random
import struct

import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from riskloom.llm import bpe, queries, warc
from riskloom.sources.scratch import new_folder
from tests.llm.fixtures import ROWS, frame, prose


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, key int")


BIG = "<p>" + prose(1, 400) + "</p>"
PAGES = [(1, "http://a/ b\r\nX: y", BIG), (2, None, BIG), (7, "http://é", BIG), (7, "http://é", BIG), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
         (None, "u", BIG), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (9, "u", "ü" * 100_000)] + [(20 + i, f"http://h/{i}", "<html>" + prose(i, 150)) for i in range(60)]


def test_round_trip(spark):
    archives = warc.archived(pages(spark, PAGES))
    back = warc.read(archives).collect()
    assert len(back) == len(PAGES) == sum(r.records for r in archives.collect())
    html = {p[0]: (p[2] or "").encode() for p in PAGES}
    for r in back:
        assert r.payload_digest == hashlib.sha1(html[r.page_id]).hexdigest() and r.payload_bytes == len(html[r.page_id])
        copy = r.page_id in (1, 2, None)
        assert (r.record_type, r.refers_to) == (("revisit", 7) if copy else ("response", None))
        assert r.payload is None if copy else bytes(r.payload) == html[r.page_id]
    assert warc.read(warc.archived(pages(spark, PAGES[:0]))).count() == 0


def test_archive_layout(spark):
    rows = warc.payloads(pages(spark, PAGES))
    trained = warc.dictionary(rows)
    path = warc.write(warc.classified(rows).coalesce(1), new_folder(spark, "one-archive"), trained).first().path
    raw = open(path.removeprefix("file:"), "rb").read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and raw[8:8 + size] == trained and trained
    # Every record is a frame that opens on its own, given the dictionary.
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained)).decompressobj()
    assert opener.decompress(raw[8 + size:]).startswith(b"WARC/1.1\r\n") and opener.unused_data[:4] == b"\x28\xb5\x2f\xfd"
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(raw[:-5])))
    plain = warc.write(warc.classified(rows), new_folder(spark, "no-dictionary"))
    assert warc.read(plain, bodies=False).count() == len(PAGES)


def test_damage_is_seen():
    row = {"page_id": 1, "url": None, "payload": b"abc", "payload_bytes": 3, "payload_digest": hashlib.sha1(b"abc").hexdigest(), "record_type": "response", "refers_to": None}
    raw = warc.record(row)
    assert warc.parsed(raw)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"abc", b"abd"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_agrees_with_the_library(library):
    words = bpe.Vocabulary(queries.vocabulary())
    draw = random.Random(3)
    texts = ["", " ", "a", "\n\n x", "<|endoftext|>", "ab<|endoftext|><|endoftext|> c", "<|endoftext", "a" * 700, "ab" * 300, " " * 90 + "x", "日本語 \U0001f389\U0001f389", "don't I'll WE'VE", " x y",
             "".join(chr(draw.randrange(32, 0x2fff)) for _ in range(2000)), "".join(draw.choice("abcdefgh \n'tsré1") for _ in range(4000)), "1234567890 " * 40, "\x00\x01\x7f", "ſ ́e"]
    texts += ["".join(draw.choice("etaoinshr ") for _ in range(60)) for _ in range(200)] + [r[1] for r in ROWS if r[1]]
    memory = bpe._Memory(words)
    table = bpe.Offsets(queries.vocabulary())
    import numpy as np
    for t in texts:
        ids = words.encode(t, memory)
        assert ids == library.encode(t, add_special_tokens=False).ids
        assert table.decode_flat(np.array(ids, np.int64), np.array([len(ids)])) == [t.encode()]


def test_memory_is_bounded_and_decides_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    words = bpe.Vocabulary(queries.vocabulary())
    memory = bpe._Memory(words)
    text = prose(2, 500)
    assert words.encode(text, memory) == library.encode(text, add_special_tokens=False).ids and len(memory) <= 10 and len(words.pairs) <= 10


def test_frames(spark, library):
    docs = frame(spark, ROWS)
    tokens = bpe.encoded(docs, queries.vocabulary(), keep=("doc_id", "size"))
    assert tokens.columns == ["doc_id", "size", "ids"]
    back = bpe.decoded(tokens, queries.vocabulary()).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((r[0] or -1, r[1] or "") for r in ROWS)
    got = {r.doc_id: list(r.ids) for r in tokens.collect() if r.doc_id}
    assert all(got[r[0]] == library.encode(r[1] or "", add_special_tokens=False).ids for r in ROWS if r[0])
    assert bpe.encoded(docs.limit(0), queries.vocabulary()).count() == 0
    broken = spark.createDataFrame([(1, [0, 200]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decoded(broken, queries.vocabulary()).collect()}[2] == ""
