"""Vector code compression: integer codebooks per part of the vector, entries found by a GNAT.

The entries of a codebook stand in a geometric near-neighbour access tree: a node has split points,
each entry below it belongs to its nearest one, and every split point knows the range of its
distances to the entries of each child. A query's distance to one split point bounds its distance
to every entry of every child, so whole subtrees drop out. Bounds are rounded outwards and only a
bound strictly above the best distance excludes, so that ties survive; what is left is compared by
whole numbers, where the lower index wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components are cut here (32,768 before scaling), so that no squared distance leaves 64 bits.
MOST = 1 << 25
#: Split points of a node; nodes with no more entries than this are leaves.
SPLITS = 12
#: Vectors that a task searches at once.
BLOCK = 4096
_OUTWARDS = 1e-9


def squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of whole numbers.

    Through doubles where every sum on the way is below 2**53 (then they are exact), else in 64-bit integers.
    """
    most = max(int(np.abs(queries).max(initial=0)), int(np.abs(points).max(initial=0)))
    if 4 * most * most * max(1, queries.shape[1]) < 1 << 53:
        a, b = queries.astype(np.float64), points.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    out = np.empty((len(queries), len(points)), np.int64)
    for j, p in enumerate(points):
        gap = queries - p
        out[:, j] = (gap * gap).sum(axis=1)
    return out


@dataclass
class Node:
    """Split points ``entries`` (indexes), the children below them, and per (split point, child) the range of distances."""

    entries: np.ndarray
    children: list[Node | None]
    low: np.ndarray
    high: np.ndarray


def _spread(points: np.ndarray, count: int) -> np.ndarray:
    """Places of ``count`` points that lie far from one another: each next one is the farthest from those before."""
    chosen = [0]
    away = squared(points, points[:1])[:, 0]
    while len(chosen) < count:
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, squared(points, points[chosen[-1:]])[:, 0])
    return np.array(chosen)


def build(points: np.ndarray, entries: np.ndarray | None = None) -> Node | None:
    """The tree over rows of whole numbers; equal points may repeat. None where there are none."""
    entries = np.arange(len(points)) if entries is None else entries
    if not len(entries):
        return None
    if len(entries) <= SPLITS or not squared(points[entries], points[entries[:1]]).any():
        return Node(entries, [], np.empty((0, 0)), np.empty((0, 0)))
    split = _spread(points[entries], SPLITS)
    rest = np.setdiff1d(np.arange(len(entries)), split)
    away = squared(points[entries[rest]], points[entries[split]])
    owner = np.argmin(away, axis=1)
    roots = np.sqrt(away.astype(np.float64))
    children, low, high = [], np.full((SPLITS, SPLITS), np.inf), np.full((SPLITS, SPLITS), -np.inf)
    for j in range(SPLITS):
        mine = owner == j
        children.append(build(points, entries[rest[mine]]))
        if mine.any():
            low[:, j], high[:, j] = roots[mine].min(axis=0) * (1 - _OUTWARDS), roots[mine].max(axis=0) * (1 + _OUTWARDS)
    return Node(entries[split], children, low, high)


def nearest(tree: Node | None, points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per query the index of its nearest point and the squared distance; ties go to the lower index."""
    best = np.full(len(queries), np.iinfo(np.int64).max)
    index = np.full(len(queries), len(points), np.int64)

    def visit(node: Node, at: np.ndarray) -> None:
        away = squared(queries[at], points[node.entries])
        order = np.argsort(node.entries)  # argmin takes the first of equals: the lowest index
        pick = np.argmin(away[:, order], axis=1)
        far, which = away[np.arange(len(at)), order[pick]], node.entries[order[pick]]
        better = (far < best[at]) | ((far == best[at]) & (which < index[at]))
        best[at[better]], index[at[better]] = far[better], which[better]
        if not node.children:
            return
        roots = np.sqrt(away.astype(np.float64))
        near, beyond = roots * (1 - _OUTWARDS), roots * (1 + _OUTWARDS)
        bound = np.stack([np.maximum(near - node.high[:, j], node.low[:, j] - beyond).max(axis=1) for j in range(SPLITS)], axis=1)
        for j in np.argsort(bound.mean(axis=0)):
            if node.children[j] is not None:
                open_ = bound[:, j] <= np.sqrt(best[at].astype(np.float64)) * (1 + _OUTWARDS)
                if open_.any():
                    visit(node.children[j], at[open_])

    if tree is not None:
        for start in range(0, len(queries), BLOCK):
            visit(tree, np.arange(start, min(start + BLOCK, len(queries))))
    return index, best


def kept(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, parts``: the rows whose vector is whole and finite, as whole numbers floor(1024 x)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    cut = F.transform("v", lambda x: F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), x * SCALE))).cast("int"))
    return rows.select("vec_id", "label", cut.alias("parts"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as an array (rows, parts, width); components beyond the last whole part are left out."""
    values = np.asarray(column.flatten(), np.int64).reshape(len(column), -1)
    return values[:, :PARTS * width].reshape(len(column), PARTS, width)


def _round(width: int, books: np.ndarray):
    """A pass over the vectors: per part and entry how many parts chose it and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(books[p]) for p in range(PARTS)]
        n, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            rows = _matrix(batch.column("parts"), width)
            for p in range(PARTS):
                index, _ = nearest(trees[p], books[p], rows[:, p])
                np.add.at(n[p], index, 1)
                np.add.at(sums[p], index, rows[:, p])
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "sums"])

    return run


def _assign(width: int, books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(books[p]) for p in range(PARTS)]
        for batch in batches:
            rows = _matrix(batch.column("parts"), width)
            error, digits = np.zeros(len(rows), np.int64), np.empty((len(rows), PARTS), np.uint8)
            for p in range(PARTS):
                digits[:, p], far = nearest(trees[p], books[p], rows[:, p])
                error += far
            codes = [d.tobytes().hex() for d in digits]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


@dataclass(frozen=True)
class Codes:
    """Codebooks (parts, entries, width) and the coded vectors ``vec_id, label, code, error``."""

    books: np.ndarray
    coded: DataFrame

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame) -> Codes:
    """Fit the codebooks in `ROUNDS` rounds over all kept vectors, then code every one of them.

    The driver holds the codebooks alone: at most 256 entries of the vector's length. A round is one pass that sends
    back the sums of each task, added up by Spark. The first entries are the vectors of the 256 smallest ids (of
    equal ids, by their numbers; rows without id come last). The vector length is that of the first
    entry; vectors of another length have no parts of the same kind and are left out. A length that four does not divide loses its last components.
    """
    spark = vectors.sparkSession
    rows = stored(kept(vectors), "codes-parts")
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "parts").select("parts")
    lead = seeds.first()
    if lead is None:
        return Codes(np.zeros((PARTS, 0, 0), np.int64), spark.createDataFrame([], rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema))
    length = len(lead["parts"])
    width = length // PARTS
    rows = rows.where(F.size("parts") == length)
    first = np.array([r["parts"] for r in seeds.where(F.size("parts") == length).limit(ENTRIES).collect()], np.int64)
    books = np.ascontiguousarray(first[:, :PARTS * width].reshape(len(first), PARTS, width).transpose(1, 0, 2))
    for _ in range(ROUNDS):
        told = rows.select("parts").mapInArrow(_round(width, books), "part int, entry int, n long, sums array<long>")
        added = told.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)])
        books = books.copy()
        for r in added.collect():
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    return Codes(books, stored(rows.mapInArrow(_assign(width, books), schema), "codes-coded"))


def coded(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept vector.

    Left out are rows whose vector is null, holds null or non-finite components, or has another length than that
    of the smallest id. Numbers beyond 2**25 count as 2**25. Fewer than 256 vectors make smaller codebooks; equal entries are
    legal, the first of them is used. Repeated rows are coded and counted as often as they come; rows
    without label share one sum. An empty table gives no rows; other columns are not read.
    """
    found = compress(vectors)
    sums = stored(found.coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")  # its size is known, so Spark broadcasts it while it is small
    joined = found.coded.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(found.digest).alias("codebooks_sha256"))
