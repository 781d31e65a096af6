"""Mixing sources to target weights by pivotal dependent rounding.

A document's wanted number of copies is its source's target over the source's size. Whole copies
are given; the fractions are rounded in pairs: words move from one document to the other, at
random but with nothing gained or lost on average, until one of the two is whole. A source's words
stay what they were through every pair, so its total misses the target by less than one document.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import WORD, stored, unwrapped, whole_row

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
#: Documents that one group rounds, and residuals that one group of the tree combines.
LEAF, FAN = 4096, 1024
_EDGE = 1e-9


def _spots() -> tuple[Column, Column]:
    """Two hashes of id, text and source. Rows are told apart by both and the id: one alone would confuse some of ten billion rows."""
    values = F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string")
    return F.xxhash64(*values), F.xxhash64(F.lit("again"), *values)


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, spot, again`` for every row; size is the number of words, ``spot`` and ``again`` are two hashes of the row's own values."""
    text = F.col("text").cast("string")
    spot, again = _spots()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       spot.alias("spot"), again.alias("again"))


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict:
    """Target words per source from ``(source, size)``: sources in code point order, null last, weights repeating.

    ``share`` times all words are divided by weight; whoever would exceed ``most`` times its own
    size gets exactly that, and the excess goes to the others by weight, until none is above.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, left, given, open_ = dict(order), share * sum(n for _, n in order), {}, [s for s, _ in order]
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > most * size[s]]
        if not full:
            return given | {s: weight[s] * unit for s in open_}
        given |= {s: most * size[s] for s in full}
        left -= sum(given[s] for s in full)
        open_ = [s for s in open_ if s not in given]
    return given


def source_targets(rows: DataFrame) -> DataFrame:
    """``source, source_size, n_docs, target``: one row per source.

    Sources are names of collections; their table (not their documents) is what the driver sees,
    as the resharing of excess needs all of them at once.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")).collect()
    given = targets([(r["source"], r["source_size"]) for r in per])
    data = [(r["source"], r["source_size"], r["n_docs"], float(given[r["source"]])) for r in per]
    made = rows.sparkSession.createDataFrame(data, "source string, source_size long, n_docs long, target double")
    return stored(made.coalesce(1), "mix-sources")  # a file's size is known, so Spark broadcasts it while it is small


def pivot(fractions: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round fractions pair by pair; returns the fractions, 0 or 1 but for one, and that one's index (-1: none).

    Of a pair (a, b) words move one way or the other until one of them is 0 or 1. The chance of
    each way is in inverse ratio to the words it moves, so every document keeps its fraction on average.
    """
    x, open_ = fractions.astype(float).copy(), -1
    for i in range(len(x)):
        if x[i] <= _EDGE or x[i] >= 1 - _EDGE:
            x[i] = round(x[i])
            continue
        if open_ < 0:
            open_ = i
            continue
        a, b, s, t = x[open_], x[i], float(sizes[open_]), float(sizes[i])
        up, down = min((1 - a) * s, b * t), min(a * s, (1 - b) * t)
        move = up if draws[i] * (up + down) < down else -down
        a, b = a + move / s, b - move / t
        a, b = (round(v) if v <= _EDGE or v >= 1 - _EDGE else v for v in (a, b))
        x[open_], x[i] = a, b
        open_ = open_ if 0 < a < 1 else i if 0 < b < 1 else -1
    return x, open_


def _unit(*parts) -> Column:
    """A draw in [0, 1) that only depends on the arguments."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0 ** -53)


def _round_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["spot", "doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
    x, left = pivot(pdf["part"].to_numpy(), pdf["size"].to_numpy(), pdf["draw"].to_numpy())
    pdf["part"] = x
    pdf["open"] = False
    if left >= 0:
        pdf.loc[left, "open"] = True
    return pdf


def mix(docs: DataFrame, seed: int = 42) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken, spot, again``: how often the mix takes each row of ``docs``.

    Copies times size is taken; no row is taken more than twice. Null texts and texts without words
    have size 0 and are never taken; null sources are one source; rows repeat as they come (rows equal
    in id, source and text are interchangeable). The draws are hashes of ``seed`` and the row, so
    reruns agree whatever the partitioning. No documents give no rows.

    The tree: a source is cut into groups of about `LEAF` documents by hash; each group rounds down
    to one open document; up to `FAN` open ones form the next group, and so on to one per source,
    which a last draw decides. A source that holds a third of all rows is just more groups. Texts
    are counted where they are read and never shuffled.
    """
    rows = stored(sized(docs), "mix-sizes")
    per_source = source_targets(rows)
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    joined = rows.withColumn("k", key(F.col("source"))).join(
        per_source.select(key(F.col("source")).alias("k"), "source_size", "n_docs", "target"), "k")
    wanted = F.when(F.col("source_size") > 0, F.least(F.lit(MOST), F.col("target") / F.col("source_size"))).otherwise(0.0)
    wanted = F.when(F.col("size") > 0, wanted).otherwise(0.0)
    level = joined.select("k", "doc_id", "spot", "again", "size", "source_size", "target", F.floor(wanted).cast("long").alias("whole"),
                          (wanted - F.floor(wanted)).alias("part"),
                          F.pmod(F.xxhash64(F.lit(seed), "spot"), F.ceil(F.col("n_docs") / LEAF)).alias("bin"))
    done, depth = [], 0
    most = max((r[0] for r in per_source.select("n_docs").collect()), default=0)
    bins = -(-most // LEAF)
    while True:
        drawn = level.withColumn("draw", _unit(F.lit(seed), F.lit(depth), F.col("spot"), F.col("doc_id")))
        kept = [f for f in drawn.schema.names]
        schema = ", ".join(f"{n} {t}" for n, t in drawn.dtypes) + ", open boolean"
        rounded = stored(drawn.groupBy("k", "bin").applyInPandas(_round_group, schema), f"mix-level{depth}")
        done.append(rounded.where("not open").select(*kept))
        level = rounded.where("open").select(*[c for c in kept if c != "draw"]).withColumn("bin", F.floor(F.col("bin") / FAN))
        if bins <= 1:
            break
        depth, bins = depth + 1, -(-bins // FAN)
    last = level.withColumn("draw", _unit(F.lit(seed), F.lit(-1), F.col("spot"), F.col("doc_id")))
    done.append(last.withColumn("part", F.when(F.col("draw") < F.col("part"), 1.0).otherwise(0.0)).select(*kept))
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    copies = (F.col("whole") + F.round("part").cast("long")).alias("copies")
    return out.select("doc_id", "size", "source_size", "target", copies, (copies * F.col("size")).alias("taken"), "spot", "again")


def mixed(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with all columns.

    Rows equal in id, source and text share their copies: each of them is repeated by the sum over
    its equals, one of them standing for all.
    """
    same = ["_id", "spot", "again"]
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id")  # the hashes tell an absent id from zero
    taken = mix(docs, seed).where("copies > 0").groupBy(id_, "spot", "again").agg(F.sum("copies").cast("int").alias("_copies"))
    spot, again = _spots()
    rows = docs.select(whole_row(docs).alias("row"), id_, spot.alias("spot"), again.alias("again"))
    one = rows.join(taken, same).dropDuplicates(same)
    return unwrapped(one.select("row", F.explode(F.sequence(F.lit(1), "_copies"))), docs.columns)
