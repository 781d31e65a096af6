"""Language identification by interpolated Kneser-Ney models over characters, one per language.

Counting reads the whole training corpus: n-grams of letters per language, summed first in the
worker and then by shuffle. Every lower order comes from the distinct n-grams of the order above
(continuation counts), by aggregations and joins over the whole table of n-grams. The models are
files in the shared folder, sorted arrays of n-gram hashes beside a matrix of log probabilities, one
column per language, which tasks map into memory; scoring is a binary search per character. The language
with the lowest cross-entropy per character wins; a text that even its best model finds less likely
than held-back training texts is rejected.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from riskloom.llm.base import remainder, slices, stored, unwrapped, whole_row
from riskloom.sources.scratch import new_folder

ORDER = 4
#: About as many n-grams are sorted and written by one task; a larger model is more files.
FILE_ROWS = 2_000_000
UNDETERMINED = "und"
#: One training document in this many calibrates and is not counted.
HELD_BACK = 32
MARGIN = 1.5
SEGMENT = 1_000_000
TEMPERATURES = tuple(0.02 * 2 ** i for i in range(12))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower-case letter, or a space for anything that is no letter."""
    letters = np.full(0x110000, _SPACE, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            letters[c] = ord(low) if len(low) == 1 else c
    return letters


_LETTERS: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Lower-case letters of a text as code points, anything between them as one space, spaces at both ends."""
    if not _LETTERS:
        _LETTERS.append(_tables())
    codes = _LETTERS[0][np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32)]
    blank = codes == _SPACE
    return codes[~(blank & np.concatenate(([False], blank[:-1])))]


def segments(text: str) -> Iterator[np.ndarray]:
    """The letters of a text in stretches that overlap by ``ORDER - 1``, so that no n-gram is lost or met twice."""
    if len(text) <= SEGMENT:
        yield letters(text)
        return
    carry = np.empty(0, np.uint32)
    for at in range(0, len(text), SEGMENT):
        codes = letters(text[at:at + SEGMENT])
        # Each stretch begins and ends with a space of its own; inside a text only real ones count.
        codes = codes[1:] if at and text[at - 1].isalpha() and text[at].isalpha() else codes
        if at + SEGMENT < len(text) and text[at + SEGMENT - 1].isalpha() and text[at + SEGMENT].isalpha():
            codes = codes[:-1]
        if len(carry) and len(codes) and carry[-1] == _SPACE and codes[0] == _SPACE:
            codes = codes[1:]
        codes = np.concatenate((carry, codes))
        yield codes
        carry = codes[-(ORDER - 1):] if len(codes) >= ORDER - 1 else codes


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n-gram of code points."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(codes) - n + 1, np.uint64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    for i in range(n):
        out = out * _BASE + wide[i:len(wide) - n + 1 + i]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of a task, per language; tables are merged whenever they have grown, so memory follows the distinct n-grams."""
    held: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def merge(lang: str, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        if lang in held:
            parts = [held[lang], *parts]
        marks, counts, grams = (np.concatenate(x) for x in zip(*parts))
        keys, first, back = np.unique(marks, return_index=True, return_inverse=True)
        held[lang] = keys, np.bincount(back, counts, len(keys)).astype(np.int64), grams[first]

    for batch in slices(batches, "text", 1_000_000):
        langs = batch.column("lang").to_pylist()
        waiting: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(langs, batch.column("text").to_pylist()):
            for codes in segments(text):
                waiting.setdefault(lang, []).append(codes)
        for lang, codes in waiting.items():
            # Texts are laid end to end; a zero keeps n-grams from reaching across.
            line = np.concatenate([x for c in codes for x in (c, np.zeros(1, np.uint32))])
            marks = hashes(line, ORDER)
            if not len(marks):
                continue
            rows = np.lib.stride_tricks.sliding_window_view(line, ORDER)
            keys, first, counts = np.unique(marks, return_index=True, return_counts=True)
            grams = rows[first]
            whole = (grams != 0).all(axis=1)
            merge(lang, [(keys[whole], counts[whole], grams[whole])])
    for lang, (_, counts, grams) in held.items():
        for at in range(0, len(counts), 50_000):
            part = np.ascontiguousarray(grams[at:at + 50_000]).astype("<u4")
            texts = [r.tobytes().decode("utf-32-le") for r in part]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(texts)), pa.array(texts), pa.array(counts[at:at + 50_000])], names=["lang", "gram", "n"])


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` of all rows with a language and a text."""
    narrow = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=None)
def _mapped(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r")


@dataclass
class Table:
    """Sorted hashes and their values: a file of each for every value of the first ``bits`` bits of the hash that occurs."""

    bits: int
    files: dict[int, str]

    def values(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``marks`` are there, and the values of those."""
        part = marks >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(marks), np.uint64)
        found, pieces, places = np.zeros(len(marks), bool), [], []
        for number in np.unique(part).tolist():
            if number in self.files:
                mine = np.flatnonzero(part == number)
                keys, values = (_mapped(f"{self.files[number]}-{x}.npy") for x in ("keys", "values"))
                at, there = Models._find(keys, marks[mine])
                found[mine[there]] = True
                pieces.append(values[at[there]])
                places.append(mine[there])
        if len(pieces) < 2:
            return (pieces[0] if pieces else np.empty((0, 1), np.float32)), found
        return np.concatenate(pieces)[np.argsort(np.concatenate(places))], found


@dataclass
class Models:
    """Kneser-Ney models of all languages.

    ``grams[k]``: sorted hashes of the (k+1)-grams of any language and their log probabilities
    (row: n-gram, column: language); ``backs[k]``: the same for contexts of k+1 letters and the log
    weight of backing off from them; either two arrays or files. ``limits``: per language the cross-entropy above which a text
    is rejected. ``temperature`` turns differences of cross-entropy into probabilities.
    """

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray] | Table]
    backs: list[tuple[np.ndarray, np.ndarray] | Table]
    floor: float
    limits: np.ndarray
    temperature: float = 1.0

    @staticmethod
    def _find(keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, marks), max(len(keys) - 1, 0))
        return at, keys[at] == marks if len(keys) else np.zeros(len(marks), bool)

    @staticmethod
    def _values(table: tuple[np.ndarray, np.ndarray] | Table, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(table, Table):
            return table.values(marks)
        at, found = Models._find(table[0], marks)
        return table[1][at[found]], found

    def logs(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of every letter after the first ``ORDER - 1``, a column per language."""
        n = ORDER
        count = len(codes) - n + 1
        out = np.zeros((max(count, 0), len(self.languages)), np.float32)
        todo = np.arange(max(count, 0))
        for k in range(n, 0, -1):
            if not len(todo):
                break
            marks = hashes(codes[n - k:], k)[todo]
            values, found = self._values(self.grams[k - 1], marks)
            out[todo[found]] += values
            todo = todo[~found]
            if k > 1 and len(todo):
                values, seen = self._values(self.backs[k - 2], hashes(codes[n - k:-1], k - 1)[todo])
                out[todo[seen]] += values
        out[todo] += self.floor
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy per letter in nats, a row per text; NaN for texts without letters."""
        stretches, owner = [], []
        for i, text in enumerate(texts):
            for codes in segments(text):
                if (codes != _SPACE).any():
                    first = not owner or owner[-1] != i
                    stretches.append(np.concatenate((np.full(ORDER - 2, _SPACE, np.uint32), codes)) if first else codes)
                    owner.append(i)
        total, letters_ = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        at = 0
        while at < len(stretches):
            # About a million letters at a time.
            end, held = at, 0
            while end < len(stretches) and (end == at or held + len(stretches[end]) <= SEGMENT):
                held += len(stretches[end])
                end += 1
            line = np.concatenate(stretches[at:end])
            sizes = np.array([len(s) for s in stretches[at:end]])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            logs = self.logs(line)
            inner = np.ones(len(logs), bool)
            for s in range(1, ORDER):
                cut = starts[1:] - s
                inner[cut[(cut >= 0) & (cut < len(logs))]] = False
            logs[~inner] = 0
            begins = np.minimum(starts, max(len(logs) - 1, 0))
            sums = np.add.reduceat(logs, begins, axis=0, dtype=np.float64) if len(logs) else np.zeros((len(sizes), len(self.languages)))
            np.add.at(total, owner[at:end], -sums)
            np.add.at(letters_, owner[at:end], np.maximum(sizes - ORDER + 1, 0))
            at = end
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(letters_[:, None] > 0, total / letters_[:, None], np.nan)


def kneser_ney(table: pd.DataFrame) -> Models:
    """Models from ``lang, gram, n``: the top order by counts, lower orders by how many letters go before.

    At each order the discount is n1 / (n1 + 2 n2); what it takes goes to the order below, and below
    single letters to a uniform share over the alphabet and one unknown letter. This is the form for
    tables that fit in memory; `fitted` is the same over any table.
    """
    languages = sorted(table["lang"].unique())
    alphabet = len({c for g in table["gram"] for c in g}) + 1
    floor = float(-np.log(max(alphabet, 2)))
    probs: list[dict[str, np.ndarray]] = [{} for _ in range(ORDER)]
    backs: list[dict[str, np.ndarray]] = [{} for _ in range(ORDER - 1)]
    width = len(languages)
    plain = np.zeros(width)
    own: list[list[pd.Series]] = []
    for lang in languages:
        counts = table.loc[table["lang"] == lang].set_index("gram")["n"].astype(float)
        levels = [counts]
        for _ in range(ORDER - 1):
            grams = levels[-1].index
            levels.append(pd.Series(1.0, index=grams.str[1:]).groupby(level=0).sum())
        own.append(levels[::-1])
    base = np.full(width, np.nan)
    for j, levels in enumerate(own):
        lower: dict[str, float] = {}
        for k, counts in enumerate(levels):
            n1, n2 = float((counts == 1).sum()), float((counts == 2).sum())
            discount = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
            context = counts.index.str[:-1]
            total = counts.groupby(context).sum()
            kinds = counts.groupby(context).size()
            weight = (discount * kinds / total).to_dict()
            sums = total.to_dict()
            here: dict[str, float] = {}
            for gram, c in zip(counts.index, counts.to_numpy()):
                below = lower[gram[1:]] if k else 1 / alphabet
                here[gram] = (c - discount) / sums[gram[:-1]] + weight[gram[:-1]] * below
                probs[k].setdefault(gram, plain * np.nan)[j] = here[gram]
            if k:
                for c, w in weight.items():
                    backs[k - 1].setdefault(c, plain + 1.0)[j] = w
            else:
                base[j] = weight.get("", 1.0) / alphabet
            lower = here

    # Where one language lacks an n-gram that another has, its own back-off value is filled in, so that one search serves all.
    for k in range(ORDER):
        for gram, row in probs[k].items():
            for j in np.flatnonzero(np.isnan(row)):
                row[j] = (backs[k - 1][gram[:-1]][j] if gram[:-1] in backs[k - 1] else 1.0) * probs[k - 1][gram[1:]][j] if k else base[j]

    def packed(rows: dict[str, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        if not rows:
            return np.empty(0, np.uint64), np.empty((0, width), np.float32)
        codes = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32).reshape(len(rows), n)
        keys = np.array([hashes(c, n)[0] for c in codes], np.uint64)
        order = np.argsort(keys)
        return keys[order], np.log(np.array(list(rows.values())))[order].astype(np.float32)

    return Models(languages, [packed(p, k + 1) for k, p in enumerate(probs)], [packed(b, k + 1) for k, b in enumerate(backs)],
                  float(np.log(np.nanmean(base))) if width else floor, np.full(width, -floor))


def _on_file(rows: DataFrame, gram: str, n: int, values: Column) -> Table:
    """``gram`` (of ``n`` letters each) and the logarithm of ``values array<double>`` as files of sorted hashes."""
    rows = stored(rows.select(F.col(gram).alias("gram"), values.alias("v")), "language-values")
    bits = max(0, int(np.ceil(np.log2(max(1, rows.count()) / FILE_ROWS))))
    folder = new_folder(rows.sparkSession, "language-model").removeprefix("file://").removeprefix("file:")
    if "://" in folder:
        raise RuntimeError("the shared folder must be a path that tasks can open")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer("".join(batch.column("gram").to_pylist()).encode("utf-32-le"), np.uint32)
            keys = hashes(codes, n)[::n]
            part = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(keys.view(np.int64)), batch.column("v")], names=["part", "key", "v"])

    def write(held: pa.Table) -> pa.Table:
        os.makedirs(folder, exist_ok=True)
        held = held.combine_chunks()
        keys = held.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in held.column("v").chunks])
        # A name of its own for each attempt: only the one that ends well is told.
        name = f"{folder}/{uuid.uuid4().hex}"
        np.save(f"{name}-keys.npy", keys[order])
        np.save(f"{name}-values.npy", np.log(flat.reshape(len(keys), -1))[order].astype(np.float32))
        return pa.table({"part": held.column("part")[:1], "name": pa.array([name])})

    made = rows.mapInArrow(hashed, "part int, key long, v array<double>").groupBy("part").applyInArrow(write, "part int, name string")
    return Table(bits, {r["part"]: r["name"] for r in made.collect()})


def fitted(counts: DataFrame) -> Models:
    """`kneser_ney` of the whole table ``lang, gram, n``, by aggregations and joins; the driver holds discounts and file names.

    A row is an n-gram with a count per language (null: the language lacks it). Its probability is
    (count - discount) / total of its context, if there is a count, and the context's back-off weight times
    the probability one order below, so languages without the n-gram have their back-off value in it.
    """
    languages = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    width = range(len(languages))
    if not languages:
        return kneser_ney(pd.DataFrame({"lang": [], "gram": [], "n": []}))
    letters_ = counts.select(F.explode(F.array(*[F.substring("gram", i + 1, 1) for i in range(ORDER)])).alias("c"))
    alphabet = letters_.distinct().count() + 1
    levels = [stored(counts.groupBy("gram").agg(*[F.max(F.when(F.col("lang") == name, F.col("n").cast("double"))).alias(f"n{j}") for j, name in enumerate(languages)]), "language-level")]
    for k in range(ORDER - 1, 0, -1):
        kinds = [F.nullif(F.count(f"n{j}"), F.lit(0)).cast("double").alias(f"n{j}") for j in width]
        levels.append(stored(levels[-1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(*kinds), "language-level"))
    grams, backs, below = [], [], None
    for k, level in enumerate(levels[::-1], 1):
        seen = level.agg(*[F.count_if(F.col(f"n{j}") == c).alias(f"{c}_{j}") for j in width for c in (1, 2)]).first()
        discounts = [min(0.95, max(0.1, seen[f"1_{j}"] / (seen[f"1_{j}"] + 2 * seen[f"2_{j}"]))) if seen[f"1_{j}"] + seen[f"2_{j}"] else 0.5 for j in width]
        sums = level.groupBy(F.substring("gram", 1, k - 1).alias("context")).agg(
            F.array(*[F.sum(f"n{j}") for j in width]).alias("total"),
            F.array(*[F.coalesce(F.lit(discounts[j]) * F.count(f"n{j}") / F.sum(f"n{j}"), F.lit(1.0)) for j in width]).alias("weight"))
        sums = stored(sums, "language-contexts")
        own = F.array(*[F.coalesce((F.col(f"n{j}") - discounts[j]) / F.col("total")[j], F.lit(0.0)) + F.col("weight")[j] * F.col("lower")[j] for j in width])
        rows = level.withColumn("context", F.substring("gram", 1, k - 1)).join(sums, "context")
        if below is None:
            base = np.array(sums.first()["weight"]) / alphabet
            rows = rows.withColumn("lower", F.array(*[F.lit(1 / alphabet)] * len(languages)))
        else:
            backs.append(_on_file(sums, "context", k - 1, F.col("weight")))
            rows = rows.withColumn("suffix", F.substring("gram", 2, k - 1)).join(below, "suffix")
        rows = stored(rows.select("gram", own.alias("p")), "language-order")
        grams.append(_on_file(rows, "gram", k, F.col("p")))
        below = rows.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
    return Models(languages, grams, backs, float(np.log(base.mean())), np.full(len(languages), np.log(max(alphabet, 2))))


def _entropy_batches(models: Models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            found = models.value.entropies(batch.column("text").to_pylist())
            flat = pa.array(np.where(np.isnan(found), 0, found).ravel())
            ends = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(ends, flat)
            lists = pc.if_else(pa.array(~np.isnan(found).any(axis=1) & (found.shape[1] > 0)), lists, None)
            keep = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*keep, lists], names=[*[c for c in batch.schema.names if c != "text"], "h"])
    return run


def cross_entropies(docs: DataFrame, models: Models, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and ``h array<double>``, a cross-entropy per language; null where the text has no letters."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = StructType([*narrow.schema.fields[:-1], StructField("h", ArrayType(DoubleType()))])
    out = narrow.mapInArrow(_entropy_batches(shared), schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "h")


def _share(temperature: float) -> Column:
    """The likeliest language's share of the likelihood of all, from cross-entropies ``h``."""
    best = F.array_min("h")
    return 1 / F.aggregate("h", F.lit(0.0), lambda total, x: total + F.exp((best - x) / temperature))


def train(docs: DataFrame) -> Models:
    """Models from all rows of ``docs`` with language and text.

    One row in `HELD_BACK` (by hash of the text) is not counted but calibrates: per language the
    rejection limit lies above the median cross-entropy of its own texts by four times the distance
    to their 99th percentile, at least by `MARGIN` (short texts vary), and never above the
    entropy of letters drawn at random; the temperature is the one of `TEMPERATURES` under which the held-back
    languages are likeliest. All n-grams count, and none reaches the driver. Without any training rows there are no languages.
    """
    known = docs.where("lang is not null and text is not null").select("lang", "text")
    held = F.pmod(F.xxhash64("text"), F.lit(HELD_BACK)) == 0
    counts = stored(gram_counts(known.where(~held)), "language-grams")
    models = fitted(counts)
    if not models.languages:
        return models
    scored = cross_entropies(known.where(held), models, ("lang",)).where("h is not null")
    scored = stored(scored.withColumn("j", F.array_position(F.array(*map(F.lit, models.languages)), F.col("lang")).cast("int")).where("j > 0"), "language-held")
    own = F.element_at("h", F.col("j"))
    sizes = scored.groupBy("j").agg(F.percentile_approx(own, F.array(F.lit(0.5), F.lit(0.99)), 10_000).alias("q")).collect()
    for row in sizes:
        middle, high = row["q"]
        models.limits[row["j"] - 1] = min(models.limits[row["j"] - 1], middle + max(MARGIN, 4 * (high - middle)))
    best = F.array_min("h")
    losses = scored.agg(*[F.sum((own - best) / t - F.log(_share(t))) for t in TEMPERATURES]).first()
    if losses[0] is not None:
        models.temperature = TEMPERATURES[int(np.argmin(list(losses)))]
    return models


def identified(docs: DataFrame, models: Models, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred, score, entropy, accepted`` for every row of ``docs``.

    The language of lowest cross-entropy per letter, ties to the smaller name; the score is its
    share of the calibrated likelihood. Null, empty and letterless texts are ``und`` with score 0,
    not accepted. A text whose best cross-entropy exceeds that language's limit keeps its
    prediction but is not accepted. Without languages everything is ``und``. Texts are read whole,
    row by row, without shuffle.
    """
    h = cross_entropies(docs, models, keep)
    names, limits = F.array(*map(F.lit, models.languages or [UNDETERMINED])), F.array(*[F.lit(float(x)) for x in (models.limits if models.languages else [0.0])])
    best = F.array_min("h")
    at = F.array_position("h", best).cast("int")
    share = _share(models.temperature)
    known = F.col("h").isNotNull() & F.lit(bool(models.languages))
    return h.select(*keep, F.when(known, F.element_at(names, at)).otherwise(UNDETERMINED).alias("lang_pred"),
                    F.when(known, share).otherwise(0.0).alias("score"), F.when(known, best).alias("entropy"),
                    F.coalesce(known & (best <= F.element_at(limits, at)), F.lit(False)).alias("accepted"))


def trained_on(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: those not held out."""
    return docs.where(remainder("doc_id", 3) != 1)


def accepted_only(docs: DataFrame) -> DataFrame:
    """The documents of ``docs`` whose language is recognised, with their columns; models come from the rows not held out."""
    models = train(trained_on(docs))
    out = identified(docs.select(whole_row(docs).alias("row"), "text"), models, ("row",))
    return unwrapped(out.where("accepted"), docs.columns)
