"""Embedding near-duplicates: sign hashing by random hyperplanes, exact cosine, connected components.

A table takes the signs of some hyperplanes as a bucket; vectors that share a bucket of any table
are compared exactly. A pair counts in the first table whose bucket both share, so the links of a
vector are counted without listing pairs. Two things keep large groups from costing their square:
equal vectors are one node, and vectors within half the linking angle of a common leader (a clump)
all link with each other, which needs no comparison at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import apart, stored
from riskloom.llm.components import components

COSINE, RECALL, SEED = 0.93, 0.99, 20_011
#: Hyperplanes per table: as many as halve the vectors down to one by one, within these ends.
LEAST_BITS, MOST_BITS = 8, 20
#: Vectors of one bucket that are compared with each other in one piece; fuller buckets are dealt as pairs of pieces.
PIECE = 512
#: Leaders are looked for in a sample of so many vectors; a leader's clump holds one in `RARE` of them at least.
SAMPLE, RARE = 2048, 100
#: Vectors and pairs that a task holds as doubles at once.
HELD, PAIRS = 4096, 16384
_MARGIN = 1e-6


def bits_for(vectors: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(2, vectors)))))


def tables_for(bits: int, cosine: float = COSINE, recall: float = RECALL) -> int:
    """How many tables find a pair at the threshold with the chance ``recall``; nearer pairs are found with more."""
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def unit(vectors: np.ndarray) -> np.ndarray:
    """The rows in doubles, divided by their length; a power of two first keeps squares in range."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    x = np.ldexp(vectors.astype(np.float64), -power)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))


def usable(embedding: Column) -> Column:
    """Whether a vector is there, not zero, and finite throughout."""
    whole = ~F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(embedding.isNotNull() & whole & F.exists(embedding, lambda v: v != 0), F.lit(False))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batch in pieces of one vector length and of bounded size."""
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims).tolist():
        which = np.flatnonzero(dims == dim)
        for at in range(0, len(which), HELD):
            yield dim, batch.take(pa.array(which[at:at + HELD]))


def _leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the sample: greedily the vector that has most others of its label within half the linking angle, until too few are left."""
    reach = math.cos(math.acos(COSINE) / 2 - _MARGIN)
    some = [b for b in batches if b.num_rows]
    if not some:
        return
    table = pa.Table.from_batches(some)
    dims, labels = np.asarray(table.column("dim")), np.array(table.column("label").to_pylist(), dtype=object)
    for dim in np.unique(dims).tolist():
        which = np.flatnonzero(dims == dim)
        x = unit(_vectors(table.column("embedding").combine_chunks().take(pa.array(which)), dim))
        near = (x @ x.T >= reach) & (labels[which][:, None] == labels[which][None, :])
        while True:
            count = near.sum(axis=1)
            best = int(np.argmax(count))
            if count[best] < max(3, table.num_rows / RARE):
                break
            yield pa.RecordBatch.from_arrays(
                [pa.array([labels[which[best]]], pa.string()), pa.array([dim], pa.int32()), pa.array([x[best].tolist()], pa.list_(pa.float64()))], names=["label", "dim", "centre"])
            gone = near[best].copy()
            near[gone] = False
            near[:, gone] = False


def leaders(nodes: DataFrame, count: int) -> list[tuple[str, int, np.ndarray]]:
    """``(label, dim, centre)``: at most `RARE` per vector length, looked for in a sample of `SAMPLE` nodes by hash.

    They only save work: whatever they are, the links are the same.
    """
    share = int(min(1.0, 4 * SAMPLE / max(1, count)) * (2 ** 31 - 1))
    drawn = F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(2 ** 31 - 1))
    sample = nodes.where(drawn <= share).orderBy(drawn, "node").limit(SAMPLE).select("label", "dim", F.col("embedding").cast("array<double>").alias("embedding"))
    found = sample.coalesce(1).mapInArrow(_leaders, "label string, dim int, centre array<double>").collect()
    return [(r["label"], r["dim"], np.array(r["centre"])) for r in found]


def _signed(bits: int, tables: int, found: list[tuple[str, int, np.ndarray]]):
    """Per node its bucket in each table, and the clump it belongs to (-1: none)."""
    reach = math.cos(math.acos(COSINE) / 2 - _MARGIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        weight = (1 << np.arange(bits)).astype(np.int32)
        for batch in batches:
            for dim, some in _by_dim(batch):
                if dim not in made:
                    made = {dim: planes(dim, bits, tables)}
                x = unit(_vectors(some.column("embedding"), dim))
                signs = ((x @ made[dim]) >= 0).reshape(len(x), tables, bits) @ weight
                labels = np.array(some.column("label").to_pylist(), dtype=object)
                clump, closest = np.full(len(x), -1, np.int32), np.full(len(x), reach)
                for i, (label, size, centre) in enumerate(found):
                    if size == dim:
                        cosine = np.where(labels == label, x @ centre, -1.0)
                        better = cosine > closest
                        clump[better], closest[better] = i, cosine[better]
                ends = pa.array(np.arange(0, (len(x) + 1) * tables, tables, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.ListArray.from_arrays(ends, pa.array(signs.astype(np.int32).ravel())), pa.array(clump)],
                                                 names=[*some.schema.names, "signs", "clump"])

    return run


def _pairs_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (row, later row of its group); ``end`` is where a row's group ends."""
    later = end - start - 1
    a = np.repeat(start, later)
    return a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)


def _connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows reaches by these pairs."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[a], low[b])
        now = low.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        now = now[now]
        if (now == low).all():
            return low
        low = now


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and pair of pieces; a group is compared once all its rows are there.

    Yields ``(node, links, other)``: how many linking vectors this group shows the node, and a node it is connected with.
    """
    held: list[pa.RecordBatch] = []

    def flushed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        marks = [np.asarray(rows.column(c)) for c in ("key", "left", "right", "dim")]
        marks.append(np.asarray(rows.column("label").combine_chunks().dictionary_encode().indices))
        new = np.concatenate(([True], np.logical_or.reduce([m[1:] != m[:-1] for m in marks])))
        first = np.flatnonzero(new)
        ends = np.append(first[1:], rows.num_rows)
        # Groups go in runs of bounded size; a group alone is bounded by two pieces.
        at = 0
        while at < len(first):
            upto = max(at + 1, int(np.searchsorted(ends, first[at] + HELD, side="right")))
            while upto > at + 1 and marks[3][first[upto - 1]] != marks[3][first[at]]:
                upto -= 1
            yield from _one_run(rows.slice(first[at], ends[upto - 1] - first[at]), first[at:upto] - first[at], ends[at:upto] - first[at])
            at = upto

    def key_of(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(c)[i].as_py() for c in ("key", "left", "right", "dim", "label"))

    for batch in batches:
        if not batch.num_rows:
            continue
        last = key_of(batch, batch.num_rows - 1)
        start = batch.num_rows
        while start > 0 and key_of(batch, start - 1) == last:
            start -= 1
        if start:
            yield from flushed(pa.Table.from_batches([*held, batch.slice(0, start)]))
            held = [batch.slice(start)]
        elif held and key_of(held[-1], 0) != last:
            yield from flushed(pa.Table.from_batches(held))
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield from flushed(pa.Table.from_batches(held))


def _one_run(rows: pa.Table, first: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
    dim = rows.column("dim")[0].as_py()
    node, weight, table = (np.asarray(rows.column(c)) for c in ("node", "copies", "at"))
    piece, clump = np.asarray(rows.column("piece")), np.asarray(rows.column("clump"))
    split = np.asarray(rows.column("left")) != np.asarray(rows.column("right"))
    x = unit(_vectors(rows.column("embedding").combine_chunks(), dim))
    signs = np.asarray(rows.column("signs").combine_chunks().flatten()).reshape(rows.num_rows, -1)
    a_all, b_all = _pairs_of(np.arange(rows.num_rows), np.repeat(ends, ends - first))
    links, low_a, low_b = np.zeros(rows.num_rows, np.int64), [], []
    for at in range(0, len(a_all), PAIRS):
        a, b = a_all[at:at + PAIRS], b_all[at:at + PAIRS]
        # Pieces meet here to be compared with each other, not within themselves; clumps are known to link throughout.
        wanted = np.flatnonzero(~(split[a] & (piece[a] == piece[b])) & ((clump[a] < 0) | (clump[a] != clump[b])))
        a, b = a[wanted], b[wanted]
        near = np.einsum("nd,nd->n", x[a], x[b]) >= COSINE
        a, b = a[near], b[near]
        before = np.arange(signs.shape[1])[None, :] < table[a][:, None]
        once = ~((signs[a] == signs[b]) & before).any(axis=1)
        a, b = a[once], b[once]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        low_a.append(a)
        low_b.append(b)
    found = np.flatnonzero(links)
    if len(found):
        low = _connected(rows.num_rows, np.concatenate(low_a), np.concatenate(low_b))
        yield pa.RecordBatch.from_arrays([pa.array(node[found]), pa.array(links[found]), pa.array(node[low[found]])], names=["node", "links", "other"])


def _met(signed: DataFrame) -> DataFrame:
    """``key, left, right, piece, at, node``: the groups in which nodes meet to be compared.

    A bucket is cut into pieces of about `PIECE` vectors of one clump (or of none) by hash. Every two
    pieces meet in a group of their own, and a piece of no clump meets itself; pieces of one clump
    need not meet. Buckets with nothing to compare drop out while they are only numbers.
    """
    keys = signed.select("node", "clump", "label", "dim", F.posexplode("signs").alias("at", "sign"))
    keys = keys.select("node", "clump", "at", F.xxhash64("label", "dim", "at", "sign").alias("key"))
    sizes = keys.groupBy("key", "clump").agg(F.count("*").alias("n"))
    cut = F.ceil(F.col("n") / PIECE).cast("int")
    buckets = sizes.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("clump", cut.alias("pieces")))).alias("parts"), F.sum("n").alias("all"))
    buckets = buckets.where("all > 1 and (size(parts) > 1 or parts[0].clump < 0)")
    owner = F.flatten(F.transform("parts", lambda p: F.array_repeat(p["clump"], p["pieces"])))
    buckets = buckets.select("key", "parts", owner.alias("owner"))
    met = keys.join(apart(buckets, "key"), "key")
    before = F.aggregate("parts", F.lit(0), lambda n, p: n + F.when(p["clump"] < F.col("clump"), p["pieces"]).otherwise(0))
    own = F.element_at(F.filter("parts", lambda p: p["clump"] == F.col("clump")), 1)["pieces"]
    met = met.withColumn("piece", (before + F.pmod(F.xxhash64("node"), own.cast("long")).cast("int")))
    others = F.filter(F.sequence(F.lit(0), F.size("owner") - 1), lambda i: (F.col("clump") < 0) | (F.get("owner", i) != F.col("clump")))
    met = met.select("key", "piece", "at", "node", F.explode(others).alias("with"))
    return met.select("key", F.least("piece", "with").alias("left"), F.greatest("piece", "with").alias("right"), "piece", "at", "node")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors of one label link at a cosine of 0.93 or more. ``n_links`` counts the linked vectors that
    differ in id or in numbers, ``component_id`` is the smallest vec_id reachable, the own one
    included, and ``kept`` says that it is the own one. Rows without label, and vectors that are null,
    empty, zero or hold null or non-finite components, link with nothing; vectors of different length
    do not link. Repeated rows are one vector and stay repeated; an id with several vectors is several
    vectors. A row without id has links like any other, names no component, and is kept where its component
    has no id at all. No rows give no rows; other columns are not read.

    A pair at the threshold is found with a chance of 0.99, nearer ones almost surely (0.9999 at
    a cosine of 0.97); nothing below it links. The number of hyperplanes follows the logarithm of the number of vectors,
    so that buckets of unlike vectors stay small, and the number of tables follows from the recall.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast(kind).alias("embedding"))
    linkable = F.col("label").isNotNull() & usable(F.col("embedding"))
    single = rows.where(linkable).groupBy("label", "embedding", "vec_id").agg(F.count("*").alias("n"))
    members = F.sum(F.when(F.col("vec_id").isNull(), F.col("n")).otherwise(1)).alias("copies")
    nodes = single.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), members)
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "label", "embedding", F.size("embedding").alias("dim"), "first", "copies"), "vectors-nodes")
    count = nodes.count()
    bits = bits_for(count)
    tables = tables_for(bits)
    schema = f"node long, label string, dim int, embedding {kind}, copies long, first long, signs array<int>, clump int"
    signed = nodes.select("node", "label", "dim", "embedding", "copies", "first").mapInArrow(_signed(bits, tables, leaders(nodes, count)), schema)
    signed = stored(signed, "vectors-signed")

    met = _met(signed).join(apart(signed.select("node", "label", "dim", "embedding", "copies", "signs", "clump"), "node"), "node")
    order = ["key", "left", "right", "dim", "label"]
    dealt = met.select(*order, "piece", "at", "node", "copies", "clump", "embedding", "signs").repartition("key", "left", "right").sortWithinPartitions(*order)
    shown = stored(dealt.mapInArrow(_compared, "node long, links long, other long"), "vectors-links")

    clumps = signed.where("clump >= 0").groupBy("clump").agg(F.min("node").alias("lead"), F.sum("copies").alias("all"))
    clumps = stored(clumps, "vectors-clumps")
    in_clump = signed.where("clump >= 0").select("node", "clump", "copies").join(clumps, "clump")
    edges = shown.select(F.col("node").alias("a"), F.col("other").alias("b")).unionByName(in_clump.select(F.col("node").alias("a"), F.col("lead").alias("b")))
    reached = components(edges.distinct())
    counted = shown.select("node", "links").unionByName(in_clump.select("node", (F.col("all") - F.col("copies")).alias("links")))
    counted = counted.groupBy("node").agg(F.sum("links").alias("links"))

    marks = [F.xxhash64("label", "embedding").alias("h1"), F.xxhash64(F.lit(SEED), "embedding", "label").alias("h2")]
    placed = nodes.select("node", "first", "copies", *marks).join(counted, "node", "left").join(reached.withColumnRenamed("id", "node"), "node", "left")
    placed = stored(placed.select("h1", "h2", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")), "vectors-placed")
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.join(apart(least, "component"), "component").select("h1", "h2", "n_links", "component_id", F.lit(True).alias("known"))
    out = rows.select("vec_id", *[F.when(linkable, m).alias(n) for m, n in zip(marks, ("h1", "h2"))]).join(apart(named, "h1"), ["h1", "h2"], "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
