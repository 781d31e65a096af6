"""SimHash near-duplicates: segment popcounts as grid cells, exact check of the bits, components.

A 64-bit fingerprint is embedded as the bit counts of its 16 four-bit segments. The Manhattan
distance of two embeddings never exceeds the Hamming distance of the fingerprints, so fingerprints
within two bits lie within distance 2 on the grid and share a cell when each enters its own cell
and the 32 beside it. Pairs that meet in a cell are checked on the bits themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import apart, slices, stored
from riskloom.llm.components import components

LINK_BITS = 2
SHINGLE_WORDS = 3
SEGMENTS, SEGMENT_BITS = 16, 4
#: Cells with more fingerprints are linked by shared bit neighbours instead of pair by pair.
FULL_CELL = 32


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a UTF-8 text; 0 where it holds no word."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends[words - 1:].tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at:at + 65536], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        marks = [fingerprint(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.int64())], names=["doc_id", "mark"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, mark)`` for every row of ``docs``; other columns are not read."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_fingerprints, "doc_id long, mark long")


def _place(mark: Column) -> Column:
    """The grid place of a fingerprint: one hexadecimal digit per segment, its bit count plus one."""
    place = F.lit(0).cast("long")
    for i in range(SEGMENTS):
        ones = F.bit_count(F.shiftrightunsigned(mark, SEGMENT_BITS * i).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)))
        place = place + F.shiftleft((ones + 1).cast("long"), 4 * i)
    return place


def _beside(place: Column) -> Column:
    """The place itself and every place one step away."""
    steps = [0] + [sign * (1 << 4 * i) for i in range(SEGMENTS) for sign in (1, -1)]
    steps = [s - (1 << 64) if s >= 1 << 63 else s for s in steps]
    return F.array(*[place + F.lit(s).cast("long") for s in steps])


def links(marks: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different fingerprints within two bits, enough of them to connect all such pairs.

    ``marks`` holds distinct longs in ``mark``. A cell with at most ``FULL_CELL`` fingerprints
    compares its pairs. The fingerprints of fuller cells take an exact way without pairs: each
    enters itself and its 64 one-bit neighbours; fingerprints that meet under a neighbour are
    within two bits of each other, any two within two bits do meet, and at most 65 can, so a star
    to the smallest one says the same as all pairs.
    """
    # The barrier keeps the place from being computed once per cell.
    placed = marks.select("mark", F.explode(F.array(_place(F.col("mark")))).alias("place"))
    cells = placed.select("mark", "place", F.explode(_beside(F.col("place"))).alias("cell"))
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    # Spark takes what explode makes for as large as the table it comes from, and would send all cells to every task.
    met = stored(cells.join(apart(shared, "cell").hint("merge"), "cell"), "simhash-cells")
    few = met.where(F.col("n") <= FULL_CELL)
    a = few.select("cell", F.col("mark").alias("a"), F.col("place").alias("pa"))
    b = few.select("cell", F.col("mark").alias("b"), F.col("place").alias("pb"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= LINK_BITS
    once = (F.col("pa") != F.col("pb")) | (F.col("cell") == F.col("pa"))
    pairs = a.join(b, "cell").where((F.col("a") < F.col("b")) & near & once).select("a", "b")
    flips = [0] + [1 << i for i in range(63)] + [-(1 << 63)]
    crowded = met.where(F.col("n") > FULL_CELL).select("mark").distinct()
    around = crowded.select("mark", F.explode(F.array(*[F.col("mark").bitwiseXOR(F.lit(f).cast("long")) for f in flips])).alias("centre"))
    stars = around.groupBy("centre").agg(F.min("mark").alias("b"), F.collect_set("mark").alias("all")).where("size(all) > 1")
    starred = stars.select(F.explode("all").alias("a"), "b").where("a != b")
    return pairs.unionByName(starred).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    The fingerprint is 16 hexadecimal digits; the component is the smallest doc_id reachable
    through links of at most two bits. A null or blank text has fingerprint zero and links like
    any other; equal fingerprints are one node, so copies never form pairs. Null ids keep their
    row; their component is the smallest id among the rest, null if there is none. Repeated rows
    stay repeated. No documents give no rows.
    """
    marked = stored(fingerprints(docs), "simhash-marks")
    nodes = stored(marked.groupBy("mark").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    reached = components(links(nodes.select("mark")))
    placed = nodes.join(reached, nodes["mark"] == reached["id"], "left").select("mark", "first", F.coalesce("component", "mark").alias("component"))
    placed = stored(placed, "simhash-placed")
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "component").select("mark", "component_id")
    digits = F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint")
    return marked.join(named, "mark").select("doc_id", digits, "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents of ``docs`` that lead their group: all columns, one document of each component.

    The leader is the smallest doc_id. Of repeated rows with the leader's id one stays; documents
    without an id cannot be told apart and all stay.
    """
    groups = near_duplicates(docs)
    leaders = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.where("doc_id is not null").join(leaders, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null"))
