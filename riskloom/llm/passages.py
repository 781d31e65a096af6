"""Substring dedup: paragraphs cut at content, MinHash bands, exact Jaccard, components.

Repeated passages start anywhere, so paragraphs are not taken at line ends: a paragraph is the 21
words from an anchor on, and anchors are the word pairs whose hash is the smallest of 31 pairs in a
row. A passage of 51 words or more that two texts share therefore holds a paragraph that both have,
wherever it stands. Paragraphs that agree in their anchor and in one of the bands' minimum hashes
are compared; their 17 five-word shingles must reach a Jaccard similarity of 0.8. What is repeated
with a paragraph on both sides, word by word, belongs to the finding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.llm.base import apart, discarded, released, slices, stored, whole_row
from riskloom.llm.components import components

PARAGRAPH, REACH, SHINGLE = 21, 31, 5
SHINGLES = PARAGRAPH - SHINGLE + 1
#: Bands of one minimum each. Unequal paragraphs that qualify agree in 16 of 18 shingles, so one band misses 1 in 9 of them and two miss 1 in 81.
BANDS = 2
#: Words of 64 bits in the map of the documents that something is wanted of.
MAP_WORDS = 1 << 18
_P = np.uint64(0x9E3779B97F4A7C15)
_P2 = np.uint64(0x9E3779B97F4A7C15 ** 2 % 2 ** 64)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + np.uint8(32), _BYTES)
_INSIDE = (_BYTES != 32) & ((_BYTES < 9) | (_BYTES > 13))
#: The primes of XXH64.
_X1, _X2, _X3, _X4, _X5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: From this length on XXH64 goes another way.
LONG_WORD = 32


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _eight(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; ``text`` holds the bytes in eights."""
    skip, at = ((at & 7) << 3).astype(np.uint64), at >> 3
    return (text.take(at) >> skip) | ((text.take(at + 1) << np.uint64(1)) << (np.uint64(63) - skip))


class _WordHash:
    """XXH64 of every lower-cased word of some texts, all words at a time, and how many words each text has."""

    def __call__(self, texts: pa.Array | list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        data = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_binary())).cast(pa.large_binary()).fill_null(b"")
        _, bounds, raw = data.buffers()
        bounds = np.frombuffer(bounds, np.int64, len(data) + 1, 8 * data.offset)
        raw = np.frombuffer(raw or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        n = len(raw)
        lower = np.zeros(n // 8 * 8 + 24, np.uint8)
        _LOWER.take(raw, out=lower[:n])
        inside = np.zeros(n + 2, bool)
        _INSIDE.take(raw, out=inside[1:-1])
        bound = np.zeros(n + 1, bool)
        bound[bounds] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | bound[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | bound[1:])) + 1
        return self._hashes(lower, starts, ends), np.diff(np.searchsorted(starts, bounds))

    @staticmethod
    def _hashes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        text, size = lower.view("<u8"), ends - starts
        h = _X5 + size.astype(np.uint64)
        for i in range(LONG_WORD // 8 - 1):
            some = np.flatnonzero(size >= 8 * (i + 1))
            h[some] = _turned(h[some] ^ (_turned(_eight(text, starts[some] + 8 * i) * _X2, 31) * _X1), 27) * _X1 + _X4
        rest = _eight(text, starts + (np.minimum(size, LONG_WORD - 1) & ~7))
        some = np.flatnonzero(size & 4)
        part = rest[some]
        h[some] = _turned(h[some] ^ ((part & np.uint64(0xFFFFFFFF)) * _X1), 23) * _X2 + _X3
        rest[some] = part >> np.uint64(32)
        for i in range(3):
            some = np.flatnonzero((size & 3) > i)
            h[some] = _turned(h[some] ^ (((rest[some] >> np.uint64(8 * i)) & np.uint64(255)) * _X5), 11) * _X1
        h = (h ^ (h >> np.uint64(33))) * _X2
        h = (h ^ (h >> np.uint64(29))) * _X3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(size >= LONG_WORD).tolist():
            h[i] = xxhash.xxh64_intdigest(lower[starts[i]:ends[i]].tobytes())
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _least(x: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The smallest of every ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return pick(x[:-rest], x[rest:]) if rest else x


def _content(h: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The hash of the paragraph from each of these words on."""
    content = np.zeros(len(start), np.uint64)
    for i in range(PARAGRAPH):
        content = content * _P + h[start + i]
    return _mixed(content)


class _Paragraphs:
    """The paragraphs of some texts: owner, place (words before it), content hash, band keys, and where they start in the joined words."""

    def __init__(self, texts: pa.Array | list[bytes | None], hashes: _WordHash) -> None:
        h, sizes = hashes(texts)
        self.shingles = np.empty(0, np.uint64)
        n = len(h)
        if n <= REACH:  # of the whole slice; what one text must have is checked below
            self.start = np.empty(0, np.int64)
        else:
            ends = np.cumsum(sizes)
            end = np.repeat(ends, sizes)
            at = np.arange(n)
            h2 = h[:-1] * _P + h[1:]
            h4 = h2[:-2] * _P2 + h2[2:]
            pairs = _mixed(h2) | np.uint64(1)
            low = _least(pairs, REACH)
            low[at[:len(low)] + REACH >= end[:len(low)]] = 0  # the pairs must lie in one text
            edge = np.zeros(REACH - 1, np.uint64)
            high = _least(np.concatenate((edge, low, edge)), REACH, np.maximum)[:len(pairs)]
            found = np.flatnonzero(high == pairs)
            self.start = found[found + PARAGRAPH <= end[found]]
            self.shingles = _mixed(h4[:-1] * _P + h[4:])
        s = self.start
        self.owner = np.searchsorted(np.cumsum(sizes), s, side="right")
        self.place = s - np.concatenate(([0], np.cumsum(sizes)))[self.owner]
        if not len(s):
            self.content = np.empty(0, np.uint64)
            self.keys = [np.empty(0, np.uint64)] * BANDS
            return
        self.content = _content(h, s)
        anchor = pairs[s]
        self.keys = [_mixed(_least(_mixed(self.shingles + np.uint64(0xA5A5 * (b + 1))), SHINGLES)[s] ^ anchor * np.uint64(2 * b + 3)) for b in range(BANDS)]

    def deletions(self, which: np.ndarray) -> np.ndarray:
        """Per paragraph one key for each shingle left out: a sum over the others. Repeated shingles are told apart by their number."""
        bag = np.sort(self.shingles[self.start[which][:, None] + np.arange(SHINGLES)], axis=1)
        again = np.zeros(bag.shape, np.uint64)
        for j in range(1, SHINGLES):
            again[:, j] = np.where(bag[:, j] == bag[:, j - 1], again[:, j - 1] + np.uint64(1), np.uint64(0))
        bag = _mixed(bag + again * _P)
        return bag.sum(axis=1, dtype=np.uint64)[:, None] - bag


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHash()
    for batch in slices(batches, "text"):
        p = _Paragraphs(batch.column("text"), hashes)
        if len(p.start):
            ids = batch.column("doc_id").take(pa.array(p.owner))
            yield pa.RecordBatch.from_arrays([ids, pa.array(p.place.astype(np.int32)), _signed(p.content), *map(_signed, p.keys)],
                                             names=["doc_id", "place", "content", *[f"key{b}" for b in range(BANDS)]])


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _among(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs``: all whose doc_id is in ``wanted``, and few others, so that the other texts are not shuffled to find out.

    A map of bits of bounded size tells, which every task gets; with more ids than bits it says little, and the join that follows is exact.
    """
    spot = F.xxhash64("doc_id")
    word, bit = spot.bitwiseAND(F.lit(MAP_WORDS - 1)).alias("word"), F.shiftrightunsigned(spot, 58).cast("int")
    words = wanted.select(word, F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return docs.select("*", word).join(F.broadcast(words), "word").where(F.getbit("bits", bit) == 1).select(*docs.columns)


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, place, content, key0, key1``: every paragraph of every text."""
    keys = ", ".join(f"key{b} long" for b in range(BANDS))
    return _narrow(docs).mapInArrow(_paragraphs, f"doc_id long, place int, content long, {keys}")


def _similar(docs: DataFrame, met: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between unequal paragraphs that met under a key and reach the similarity.

    With 17 shingles on each side (repeats counted) that means sharing 16, which is sharing the key of
    what is left when one is taken out. So each paragraph enters 17 keys, those under one key are
    similar to each other, and a star to the smallest says the same as all their pairs. The shingles
    come from the first text that holds the paragraph; other texts stay out of it.
    """
    several = met.groupBy("key").agg(F.min("content").alias("lo"), F.max("content").alias("hi")).where("lo != hi").select("key")
    wanted = stored(met.join(apart(several, "key"), "key", "left_semi").groupBy("content").agg(F.min("doc_id").alias("doc_id")), "passages-wanted")
    released(docs.sparkSession)
    lists = wanted.groupBy("doc_id").agg(F.collect_set("content").alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHash()
        for batch in slices(batches, "text"):
            p = _Paragraphs(batch.column("text"), hashes)
            asked = batch.column("wanted")
            marks = np.asarray(asked.flatten(), np.int64).view(np.uint64)
            owner = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(asked)))
            pairs = {(o, m) for o, m in zip(owner.tolist(), marks.tolist())}
            which = np.array([i for i, x in enumerate(zip(p.owner.tolist(), p.content.tolist())) if x in pairs], np.int64)
            if len(which):
                gone = p.deletions(which)
                yield pa.RecordBatch.from_arrays([_signed(np.repeat(p.content[which], SHINGLES)), _signed(np.ascontiguousarray(gone.ravel()))], names=["content", "rest"])

    texts = _among(_narrow(docs), wanted).join(lists, "doc_id").select("doc_id", "text", "wanted")
    entered = stored(texts.mapInArrow(run, "content long, rest long").distinct(), "passages-rests")
    discarded(wanted)
    centres = entered.groupBy("rest").agg(F.min("content").alias("b"), F.max("content").alias("hi")).where("b != hi").select("rest", "b")
    found = stored(entered.join(apart(centres, "rest"), "rest").where("content != b").select(F.col("content").alias("a"), "b").distinct(), "passages-similar")
    discarded(entered)
    return found


class _Runs:
    """Hashes of any runs of words of some texts, by differences of one running sum."""

    def __init__(self, h: np.ndarray) -> None:
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(_P, len(h)), dtype=np.uint64)))
        self.back = _powers(np.uint64(pow(int(_P), -1, 2 ** 64)), len(h) + 1)

    def __call__(self, start: np.ndarray, words: np.ndarray, key: np.ndarray) -> np.ndarray:
        run = (self.sums[start + words] - self.sums[start]) * self.back[start]
        return _mixed((run + key) ^ (words.astype(np.uint64) * _P2))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    x = np.full(count, base, np.uint64)
    x[:1] = 1
    return np.cumprod(x, dtype=np.uint64)


def _beside(run: _Runs, start: np.ndarray, side: np.ndarray, passage: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of the ``words`` nearest words before (side 0) or after (side 1) the paragraph that starts at ``start``, in its class."""
    key = _mixed(passage.view(np.uint64) * np.uint64(2) + side.astype(np.uint64))
    return run(np.where(side == 0, start - words, start + PARAGRAPH), words, key)


def _hashed(batch: pa.RecordBatch, hashes: _WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of texts and what is wanted of them (a list of structs each): word hashes, words per text, owner of each wish, and the wishes' fields."""
    h, sizes = hashes(batch.column("text"))
    asked = batch.column("wanted")
    flat = asked.flatten()
    fields = [np.asarray(flat.field(i)) for i in range(flat.type.num_fields)]
    return h, sizes, np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(asked))), fields


def _wishes(docs: DataFrame, wanted: DataFrame, *fields: str) -> DataFrame:
    """The texts that something is wanted of, with the list of it; a list is bounded by the text's own length."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    return _among(_narrow(docs), wanted).join(lists, "doc_id").select("doc_id", "text", "wanted")


def _windows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, place, side, passage, size, first, whole``: the up to `REACH` - 1 words before (side 0) and after (side 1) each wanted paragraph.

    ``wanted`` has ``doc_id, place, content, passage``. ``size`` words are there, ``first`` is the hash of the nearest one and ``whole`` that of all: equal in one
    class and side where the words are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHash()
        for batch in slices(batches, "text"):
            h, sizes, owner, (place, content, passage) = _hashed(batch, hashes)
            at, starts, runs = place.astype(np.int64), np.cumsum(sizes) - sizes, _Runs(h)
            # Repeated rows of one doc_id may differ in text: only those that have the paragraph there are asked.
            has = np.flatnonzero(at + PARAGRAPH <= sizes[owner])
            has = has[_content(h, (starts[owner] + at)[has]) == content[has].view(np.uint64)]
            at, owner, passage = at[has], owner[has], passage[has]
            for side, room in ((0, at), (1, sizes[owner] - at - PARAGRAPH)):
                some = np.flatnonzero(room)
                size, sides = np.minimum(room[some], REACH - 1), np.full(len(some), side, np.int32)
                first, whole = (_beside(runs, (starts[owner] + at)[some], sides, passage[some], n) for n in (np.ones_like(size), size))
                ids = batch.column("doc_id").take(pa.array(owner[some]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(at[some].astype(np.int32)), pa.array(sides), pa.array(passage[some]), pa.array(size.astype(np.int32)), _signed(first), _signed(whole)],
                                                 names=["doc_id", "place", "side", "passage", "size", "first", "whole"])

    return _wishes(docs, wanted, "place", "content", "passage").mapInArrow(run, "doc_id long, place int, side int, passage long, size int, first long, whole long")


def _prefixes(docs: DataFrame, folded: DataFrame) -> DataFrame:
    """``whole, doc_id, hi, size, marks``: for windows told by one place of each, the hashes of their nearest 1, 2, ... words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHash()
        for batch in slices(batches, "text", 1_000_000):
            h, sizes, owner, fields = _hashed(batch, hashes)
            starts, runs = np.cumsum(sizes) - sizes, _Runs(h)
            place, side, passage, size, whole, hi = fields
            at = place.astype(np.int64)
            fits = np.flatnonzero((size <= np.where(side == 0, at, sizes[owner] - at - PARAGRAPH)) & (at + PARAGRAPH <= sizes[owner]))
            # Repeated rows of one doc_id may differ in text: only those that have the window there are asked.
            same = _beside(runs, (starts[owner] + at)[fits], side[fits], passage[fits], size[fits].astype(np.int64)).view(np.int64) == whole[fits]
            fits = fits[same]
            start, side, passage, size = (starts[owner] + at)[fits], side[fits], passage[fits], size[fits].astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(size)))
            row = np.repeat(np.arange(len(size)), size)
            marks = _beside(runs, start[row], side[row], passage[row], 1 + np.arange(ends[-1]) - ends[row])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), _signed(marks))
            yield pa.RecordBatch.from_arrays([pa.array(whole[fits]), batch.column("doc_id").take(pa.array(owner[fits])), pa.array(hi[fits]), pa.array(size.astype(np.int32)), lists],
                                             names=["whole", "doc_id", "hi", "size", "marks"])

    return _wishes(docs, folded, "place", "side", "passage", "size", "whole", "hi").mapInArrow(run, "whole long, doc_id long, hi long, size int, marks array<long>")


#: Lengths at which windows are compared first; then the lengths between the last one shared and the next.
LEVELS = (1, 2, 4, 8, 12, 16, 20, 24, 28)


def _several(rows: DataFrame) -> DataFrame:
    """``mark, least``: the marks that two documents have, and the smallest of these."""
    groups = rows.groupBy("mark").agg(F.min("doc_id").alias("least"), F.max("hi").alias("most")).where("least != most").drop("most")
    groups = stored(groups, "passages-several")
    released(rows.sparkSession)
    return groups


def _shared(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Per window the greatest ``level`` at which another document (``have``) and a smaller one (``gone``) has the ``mark``, and those marks."""
    met = rows.join(groups, "mark")
    smaller = F.when(F.col("least") < F.col("doc_id"), F.col("level"))
    # A window has one mark a level, so the mark at the greatest one is fixed.
    return met.groupBy("whole").agg(
        F.min("doc_id").alias("doc_id"), F.min("hi").alias("hi"), F.min("size").alias("size"), F.max("level").alias("have"), F.max(smaller).alias("gone"),
        F.max_by("mark", "level").alias("have_mark"), F.max_by("mark", smaller).alias("gone_mark"))


def _extents(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, place, before, after, gone_before, gone_after``: how many words next to a paragraph are repeated with it.

    ``before`` and ``after`` count what any other document of the class has beside its paragraph,
    ``gone_...`` what a smaller doc_id has. Equal windows are one, known by its smallest document. Windows that share their nearest
    word with an unequal one are compared by their hashes at `LEVELS`, then at the lengths between
    two levels, there with all windows that agree up to the lower one. Two steps whatever the data, no pairs.
    """
    # Equal windows agree in all but where they are; any place in the smallest document will do.
    same = [F.min(c).alias(c) for c in ("side", "passage", "size", "first")]
    folded = windows.groupBy("whole").agg(F.min("doc_id").alias("doc_id"), F.min_by("place", "doc_id").alias("place"), *same, F.max("doc_id").alias("hi"))
    folded = stored(folded, "passages-folded")
    released(docs.sparkSession)
    several = folded.groupBy("first").agg(F.min("doc_id").alias("lo"), F.max("hi").alias("most"), F.count("*").alias("n")).where("n > 1 and lo != most")
    asked = folded.join(apart(several.select("first"), "first"), "first", "left_semi")
    asked = stored(asked.select("doc_id", "place", "side", "passage", "size", "whole", "hi"), "passages-asked")
    released(docs.sparkSession)
    marks = stored(_prefixes(docs, asked), "passages-marks")
    discarded(asked)

    def prefixes(rows: DataFrame, *more: str) -> DataFrame:
        every = rows.select("whole", "doc_id", "hi", "size", *more, F.posexplode("marks").alias("at", "mark"))
        return every.select("whole", "doc_id", "hi", "size", *more, (F.col("at") + 1).alias("level"), "mark")

    coarse = prefixes(marks).where(F.col("level").isin(*LEVELS))
    several = _several(coarse)
    found = stored(_shared(coarse, several), "passages-coarse")
    discarded(several)
    # Where the search goes on: at the last level shared, unless it is the whole window or nothing.
    open_ = F.array(F.when((F.col("doc_id") == F.col("hi")) & (F.col("have") < F.col("size")), F.col("have_mark")), F.when(F.col("gone") < F.col("size"), F.col("gone_mark")))
    places = stored(found.select(F.explode(open_).alias("mark")).where("mark is not null").distinct(), "passages-open")
    # Only hashes are shuffled to find who takes part; the windows themselves come once, by their name, and go when the hashes between are stored.
    begun = coarse.select("whole", "level", "mark").join(places, "mark", "left_semi").groupBy("whole").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("level"))).alias("begun"))
    begun = stored(begun, "passages-begun")
    released(docs.sparkSession)
    # The level under each length at which the search may go on; none for the levels themselves.
    under = F.array(*[F.lit(None if n in LEVELS else max(x for x in LEVELS if x < n)).cast("int") for n in range(1, REACH)])
    fine = prefixes(marks.join(begun, "whole"), "begun").where(F.getbit("begun", F.get(under, F.col("level") - 1)) == 1).drop("begun")
    fine = stored(fine, "passages-fine")
    discarded(marks, places, begun)
    several = _several(fine)
    both = found.unionByName(_shared(fine, several)).groupBy("whole").agg(F.max("have").alias("have"), F.max("gone").alias("gone"))
    have = F.when(F.col("doc_id") < F.col("hi"), F.col("size")).otherwise(F.coalesce("have", F.lit(0)))
    ends = stored(folded.join(both, "whole", "left").select("whole", F.col("doc_id").alias("least"), have.alias("have"), F.coalesce("gone", F.lit(0)).alias("gone")), "passages-ends")
    discarded(folded, found, fine, several)
    told = windows.join(apart(ends, "whole"), "whole").where("have > 0 or least < doc_id")
    told = told.withColumn("gone", F.when(F.col("least") < F.col("doc_id"), F.col("size")).otherwise(F.col("gone")))

    def most(column: str, side: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col(column))), F.lit(0))

    found = stored(told.groupBy("doc_id", "place").agg(
        most("have", 0).alias("before"), most("have", 1).alias("after"), most("gone", 0).alias("gone_before"), most("gone", 1).alias("gone_after")), "passages-extents")
    discarded(ends)
    return found


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, place, words, passage, first_doc, gone``: every paragraph that occurs in two or more documents, and the run around it.

    ``passage`` is its class (equal or similar paragraphs, connected), ``first_doc`` the smallest
    doc_id of the class. From ``place`` on ``words`` words are repeated: the paragraph's, and those on
    both sides that another document of the class has there. ``gone`` is the span ``(place, words)``
    that smaller doc_ids have, null in the first document. A run of 51 words or more is the union
    of such spans, whole: its first paragraph starts in its first 31 words, its last one ends in its last 31, and no
    two in between are further apart. Rows without id or text have no paragraphs; texts of under 21 words neither.
    Repeated rows of one doc_id are one document, and what a document repeats in itself is no finding.
    Only hashes are shuffled (and the texts that hold a repeated paragraph), counts of a key are summed before the shuffle and joins on keys are left
    to skew splitting, so a passage that most documents share meets in no task as a whole.
    """
    every = stored(paragraphs(docs), "passages-paragraphs")
    keyed = every.select("doc_id", "place", "content", F.explode(F.array(*[f"key{b}" for b in range(BANDS)])).alias("key"))
    common = keyed.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo != hi").select("key")
    met = stored(keyed.join(apart(common, "key"), "key"), "passages-met")
    released(docs.sparkSession)
    linked = components(_similar(docs, met))
    named = met.select("doc_id", "place", "content").distinct().join(linked, F.col("content") == F.col("id"), "left")
    named = stored(named.select("doc_id", "place", "content", F.coalesce("component", "content").alias("passage")), "passages-named")
    discarded(every, met)
    spread = named.groupBy("passage").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).where("first_doc != last_doc").drop("last_doc")
    members = stored(named.join(apart(spread, "passage"), "passage"), "passages-members")
    windows = stored(_windows(docs, members), "passages-windows")
    discarded(named)
    extents = _extents(docs, windows)
    discarded(windows)
    found = members.join(extents, ["doc_id", "place"], "left")
    before, after, gone_before, gone_after = (F.coalesce(F.col(c), F.lit(0)) for c in ("before", "after", "gone_before", "gone_after"))
    gone = F.struct((F.col("place") - gone_before).alias("place"), (gone_before + PARAGRAPH + gone_after).alias("words"))
    return found.select("doc_id", (F.col("place") - before).alias("place"), (before + PARAGRAPH + after).alias("words"), "passage", "first_doc",
                        F.when(F.col("first_doc") != F.col("doc_id"), gone).alias("gone"))


def _covered(spans: Column) -> Column:
    """How many words lie in these spans ``(place, words)``, sorted by place; they may overlap."""
    def add(state, span):
        end = span["place"] + span["words"]
        return F.struct((state["n"] + F.greatest(F.lit(0), end - F.greatest(span["place"], state["end"]))).alias("n"), F.greatest(state["end"], end).alias("end"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), add)["n"].cast("long")


def _spans(span: Column | None = None) -> Column:
    return F.sort_array(F.collect_set(F.struct("place", "words") if span is None else span))


def documents_with_repeats(docs: DataFrame) -> DataFrame:
    """A row per document that shares a passage with another: ``doc_id, n_passages, repeated_words, removed_words, first_docs, removed``.

    ``first_docs`` lists the documents that keep its passages, ``removed_words`` counts what goes from
    this one; the lists are bounded by the document's own length. Documents that share nothing have no row.
    """
    found = repeats(docs)
    per = found.groupBy("doc_id").agg(
        F.size(F.collect_set("passage")).cast("long").alias("n_passages"), _spans().alias("spans"), _spans(F.col("gone")).alias("gone"), F.sort_array(F.collect_set("first_doc")).alias("first_docs"))
    removed = F.when(F.size("gone") > 0, _covered(F.col("gone"))).otherwise(0)
    return per.select("doc_id", "n_passages", _covered(F.col("spans")).alias("repeated_words"), removed.cast("long").alias("removed_words"),
                      "first_docs", (F.size("gone") > 0).alias("removed"))


def cut(text: str, gone: list[tuple[int, int]]) -> str:
    """The text without these spans of words ``(place, words)`` and the white space after them."""
    raw = text.encode()
    spans = [m.span() for m in _WORD.finditer(raw)]
    drop = np.zeros(len(spans), bool)
    for place, words in gone:
        drop[place:place + words] = True
    parts, at = [], 0
    for i in np.flatnonzero(drop).tolist():
        parts.append(raw[at:spans[i][0]])
        at = spans[i + 1][0] if i + 1 < len(spans) else len(raw)
    return b"".join([*parts, raw[at:]]).decode()


@F.pandas_udf(StringType())
def _cut(texts: pd.Series, places: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([None if t is None or p is None else cut(t, list(zip(p, w))) for t, p, w in zip(texts, places, words)], dtype=object)


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows of ``docs``, same columns; of each passage only the smallest doc_id keeps it.

    Texts that lose nothing are untouched, and so are rows without id or text. ``n_chars``, if there
    is one, follows the text.
    """
    lists = repeats(docs).where("first_doc != doc_id").groupBy("doc_id").agg(_spans(F.col("gone")).alias("spans"))
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id")).join(lists, "doc_id", "left")
    text = F.col("row")["text"]
    changed = F.col("spans").isNotNull() & text.isNotNull()
    rows = rows.withColumn("text", _cut(F.when(changed, text.cast("string")), F.when(changed, F.col("spans.place")), F.when(changed, F.col("spans.words"))))
    new = {"text": F.when(changed, F.col("text")).otherwise(text).alias("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("text").cast(kind)).otherwise(F.col("row")["n_chars"]).alias("n_chars")
    return rows.select(*[new.get(c, F.col("row")[c].alias(c)) for c in docs.columns])
