"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages and only the bag is labelled. Every passage is encoded; a gated
attention learned from the documents' labels weighs the codes, and their weighted sum is scored. The
model is small: it is trained on a bounded sample on the driver and applied to whole texts by tasks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import remainder, slices, stored

PASSAGE = 400
CODE, GATE = 24, 16
#: Bounds of the training sample: labelled documents (by hash of their id) and their longest text.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 4000, 100_000
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4
ACCEPTED = 0.7
_KINDS = 12
#: Features of a passage: kinds of characters, pairs of kinds, how many four-character stretches differ, its length.
FEATURES = _KINDS + _KINDS * _KINDS + 2


def _kinds() -> np.ndarray:
    """For every code point of the first plane its kind; anything beyond counts as other."""
    table = np.full(0x10000, 11, np.uint8)
    by_category = {"Ll": 1, "Lu": 2, "Lt": 2, "Lo": 3, "Lm": 3, "Nd": 4, "Zs": 0, "Mn": 3, "Mc": 3}
    for c in range(0x10000):
        category = unicodedata.category(chr(c))
        table[c] = by_category.get(category, 9 if category[0] == "P" else 10 if category[0] == "S" else 11)
    for characters, kind in ((" \t\r\f\v", 0), ("\n", 5), (".!?", 6), (",;:", 7), ("#*$%&|<>", 8)):
        for c in characters:
            table[ord(c)] = kind
    return table


_TABLE: list[np.ndarray] = []


def encode(text: str) -> np.ndarray:
    """A row of `FEATURES` numbers per passage of a text; none for an empty text."""
    if not _TABLE:
        _TABLE.append(_kinds())
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    count = -(-len(codes) // PASSAGE)
    out = np.zeros((count, FEATURES), np.float32)
    for at in range(0, count, 2500):
        part = codes[at * PASSAGE:(at + 2500) * PASSAGE]
        n = -(-len(part) // PASSAGE)
        kinds = np.where(part < 0x10000, _TABLE[0][np.minimum(part, 0xFFFF)], 11).astype(np.int64)
        owner = np.arange(len(part)) // PASSAGE
        sizes = np.bincount(owner, minlength=n)[:, None]
        single = np.bincount(owner * _KINDS + kinds, minlength=n * _KINDS).reshape(n, _KINDS)
        both = owner[1:] == owner[:-1]
        pairs = (owner[:-1] * _KINDS + kinds[:-1]) * _KINDS + kinds[1:]
        pairs = np.bincount(pairs[both], minlength=n * _KINDS * _KINDS).reshape(n, -1)
        rows = out[at:at + n]
        rows[:, :_KINDS] = single / sizes
        rows[:, _KINDS:-2] = pairs / sizes
        if len(part) >= 4:
            wide = part.astype(np.uint64)
            stretch = ((wide[:-3] * np.uint64(0x1F1F1F1F) + wide[1:-2]) * np.uint64(0x1F1F1F1F) + wide[2:-1]) * np.uint64(0x1F1F1F1F) + wide[3:]
            inner = owner[3:] == owner[:-3]
            marks = (stretch[inner] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)) | (owner[3:][inner].astype(np.uint64) << np.uint64(40))
            different = np.bincount((np.unique(marks) >> np.uint64(40)).astype(np.int64), minlength=n)
            rows[:, -2] = different / np.maximum(1, sizes[:, 0] - 3)
        rows[:, -1] = sizes[:, 0] / PASSAGE
    return out


def _sums(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts, axis=0)


@dataclass
class Model:
    """Centre and spread of the features, and the weights; ``share`` alone where nothing could be learned."""

    share: float = 0.5
    centre: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    spread: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Codes, attention and scores of bags; ``starts`` are the first rows of each."""
        w = self.weights
        sizes = np.diff(starts, append=len(x))
        h = np.tanh(x @ w["code"] + w["code0"])
        t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (t * g) @ w["attend"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(_sums(e, starts), sizes)
        z = _sums(a[:, None] * h, starts)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "score": 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -40, 40))), "sizes": sizes}

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, starts)
        h, t, g, a, sizes = f["h"], f["t"], f["g"], f["a"], f["sizes"]
        ds = (f["score"] - y) / len(y)
        dz = np.repeat(ds[:, None] * w["out"], sizes, axis=0)
        da = (h * dz).sum(1)
        de = a * (da - np.repeat(_sums(a * da, starts), sizes))
        dt = de[:, None] * w["attend"] * g * (1 - t * t)
        dg = de[:, None] * w["attend"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - h * h)
        return {"code": x.T @ dh, "code0": dh.sum(0), "tanh": h.T @ dt, "gate": h.T @ dg, "attend": (t * g).T @ de, "out": f["z"].T @ ds, "out0": ds.sum()}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1 per text; 0 for null and empty ones."""
        out = np.zeros(len(texts))
        if not self.weights:
            out[[bool(t) for t in texts]] = self.share
            return out
        bags, who, held = [], [], 0
        for i, text in enumerate(texts):
            if text:
                bags.append((encode(text) - self.centre) / self.spread)
                who.append(i)
                held += len(bags[-1])
            if bags and (held > 20_000 or i == len(texts) - 1):
                starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1]))
                out[who] = self.forward(np.concatenate(bags), starts)["score"]
                bags, who, held = [], [], 0
        if bags:
            starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1]))
            out[who] = self.forward(np.concatenate(bags), starts)["score"]
        return out


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 42) -> Model:
    """Adam on the log loss of whole documents. One class only: its share is the score of all."""
    if not len(labels) or labels.min() == labels.max():
        return Model(float(labels.mean()) if len(labels) else 0.5)
    rows = np.concatenate(bags).astype(np.float64)
    model = Model(float(labels.mean()), rows.mean(0), np.maximum(rows.std(0), 1e-3))
    bags = [(b - model.centre) / model.spread for b in bags]
    draw = np.random.default_rng(seed)
    shapes = {"code": (FEATURES, CODE), "code0": (CODE,), "tanh": (CODE, GATE), "gate": (CODE, GATE), "attend": (GATE,), "out": (CODE,), "out0": ()}
    w = model.weights = {n: draw.normal(0, 1 / np.sqrt(s[0]), s) if len(s) and not n.endswith("0") else np.zeros(s) for n, s in shapes.items()}
    first, second, step = {n: np.zeros(s) for n, s in shapes.items()}, {n: np.zeros(s) for n, s in shapes.items()}, 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            starts = np.concatenate(([0], np.cumsum([len(bags[i]) for i in some])[:-1]))
            found, step = model.gradients(np.concatenate([bags[i] for i in some]), starts, labels[some]), step + 1
            for n, d in found.items():
                d = d + DECAY * w[n]
                first[n] = 0.9 * first[n] + 0.1 * d
                second[n] = 0.999 * second[n] + 0.001 * d * d
                pace = RATE * (1 - epoch / EPOCHS) / (1 - 0.9 ** step)
                w[n] = w[n] - pace * first[n] / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, mark: str = "quality") -> Model:
    """A model from documents ``(doc_id, text)`` and labels ``(doc_id, <mark>)``; only ids, texts and marks are read.

    At most `SAMPLE_DOCUMENTS` labelled documents, the first by hash of the id, with texts of 1 to
    `SAMPLE_CHARACTERS` characters; a document with several marks has the larger one. The sample's ids
    are so few that they are broadcast, and its features are all that reaches the driver.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(mark).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(mark).alias("mark"))
    texts = docs.where(F.length("text").between(1, SAMPLE_CHARACTERS)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = stored(known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), "attention-labels")
    # Twice as many by a share of the hashes, so that the sort behind the limit stays small whatever the number of labels.
    spot = F.xxhash64(F.lit(7), "doc_id")
    few = known.where(F.pmod(spot, F.lit(max(1, known.count() // (2 * SAMPLE_DOCUMENTS)))) == 0)
    chosen = few.orderBy(spot, "doc_id").limit(SAMPLE_DOCUMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes = [encode(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(codes, pa.binary())], names=["doc_id", "mark", "codes"])

    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", F.col("mark").cast("double").alias("mark"), "text")
    rows = sample.mapInArrow(run, "doc_id long, mark double, codes binary").toPandas().drop_duplicates(["doc_id"]).sort_values("doc_id")
    bags = [np.frombuffer(c, np.float32).reshape(-1, FEATURES) for c in rows["codes"]]
    return fit(bags, (rows["mark"].to_numpy() > 0).astype(float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs``, whole texts, without shuffle; repeated rows score alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = shared.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def trained_on(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: those not held out."""
    return docs.where(remainder("doc_id", 4) != 2)
