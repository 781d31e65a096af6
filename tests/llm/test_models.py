"""Language models, quality classifier and graph search: definitions, held-out accuracy, recall."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.llm import attention, graph_search, language
from riskloom.llm.base import table
from tests.llm.fixtures import ROWS, frame, prose

SF = "/root/testdata/sf0.01"


def plain_kneser_ney(counts, alphabet):
    """The textbook recursion for one language; ``counts``: n-gram of the top order -> count."""
    levels = [dict(counts)]
    for _ in range(language.ORDER - 1):
        below = {}
        for g in levels[-1]:
            below[g[1:]] = below.get(g[1:], 0) + 1
        levels.append(below)
    levels = levels[::-1]
    discount = []
    for level in levels:
        n1, n2 = (sum(v == k for v in level.values()) for k in (1, 2))
        discount.append(min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5)

    def p(gram):
        if not gram:
            return 1 / alphabet
        level, d = levels[len(gram) - 1], discount[len(gram) - 1]
        same = [v for g, v in level.items() if g[:-1] == gram[:-1]]
        if not same:
            return p(gram[1:])
        return max(level.get(gram, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * p(gram[1:])

    return p


def test_kneser_ney_against_the_recursion():
    texts = {"xx": " abra cadabra abra bra ", "yy": " lorem ipsum dolor sit abra "}
    rows = [(lang, t[i:i + 4]) for lang, t in texts.items() for i in range(len(t) - 3)]
    counts = pd.DataFrame(rows, columns=["lang", "gram"]).groupby(["lang", "gram"]).size().reset_index(name="n")
    models = language.kneser_ney(counts)
    letters = {c for g in counts.gram for c in g}
    text = " abracadabra dolorem "
    logs = models.logs(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    for j, lang in enumerate(models.languages):
        p = plain_kneser_ney(counts[counts.lang == lang].set_index("gram")["n"].to_dict(), len(letters) + 1)
        want = [math.log(p(text[i:i + 4])) for i in range(len(text) - 3)]
        assert logs[:, j] == pytest.approx(want, abs=2e-4)
        context = text[:3]
        assert sum(p(context + c) for c in letters | {"\0"}) == pytest.approx(1)


def test_fitted_is_kneser_ney(spark, monkeypatch):
    monkeypatch.setattr(language, "FILE_ROWS", 40)
    texts = {"xx": " abra cadabra abra bra " + prose(1, 40), "yy": " lorem ipsum dolor sit abra ", "zz": " \u4e2d\u6587\U00020000 \u5b57 abra "}
    rows = [(lang, t[i:i + 4]) for lang, t in texts.items() for i in range(len(t) - 3)]
    counts = pd.DataFrame(rows, columns=["lang", "gram"]).groupby(["lang", "gram"]).size().reset_index(name="n")
    plain, got = language.kneser_ney(counts), language.fitted(spark.createDataFrame(counts))
    assert got.languages == plain.languages and got.floor == pytest.approx(plain.floor) and got.limits == pytest.approx(plain.limits)
    assert got.grams[3].bits > 0
    for text in (*texts.values(), " dolorem abracadabra \u6587\u5b57 \u0416 "):
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        assert got.logs(codes) == pytest.approx(plain.logs(codes), abs=1e-4)


def test_large_alphabets_keep_their_rare_grams(spark):
    draw = np.random.default_rng(5)
    texts = ["".join(map(chr, 0x4E00 + draw.integers(0, 2000, 4000))) for _ in range(75)]
    docs = frame(spark, [(i, t, "zh", "s") for i, t in enumerate(texts)] + [(100 + i, prose(i, 50), "en", "s") for i in range(40)])
    models = language.train(docs)
    assert models.languages == ["en", "zh"]
    got = {r.doc_id: r.lang_pred for r in language.identified(docs, models).collect()}
    assert {got[i] for i in range(75)} == {"zh"} and {got[100 + i] for i in range(40)} == {"en"}


def test_segments_meet_every_gram_once(monkeypatch):
    text = prose(3, 300) + " 12 #! " + prose(4, 50)
    whole = language.letters(text)
    monkeypatch.setattr(language, "SEGMENT", 37)
    parts = [language.hashes(c, language.ORDER) for c in language.segments(text)]
    assert np.concatenate(parts).tolist() == language.hashes(whole, language.ORDER).tolist()


def test_languages_held_out(spark):
    docs = table(spark, SF, "documents")
    out = language.identified(docs, language.train(language.trained_on(docs)), ("doc_id", "lang"))
    held = out.where(language.remainder("doc_id", 3) == 1).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"), F.avg(F.col("accepted").cast("int"))).first()
    assert held[0] > 0.98 and 0 <= held[1] and held[2] <= 1 and held[3] > 0.98


def test_language_edges_and_rejection(spark):
    docs = frame(spark, ROWS + [(100 + i, prose(i, 50), "en", "s") for i in range(40)] + [(200 + i, prose(i, 50, ("ü", "sch", "ber", "keit")), "de", "s") for i in range(40)]
                 + [(300, "zqxjkvwp qzxw jqkx vwzq " * 20, None, None), (301, "12 34 !!", "en", "s")])
    models = language.train(docs)
    got = {r.doc_id: r for r in language.identified(docs, models).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[301].lang_pred == "und" and got[301].score == 0 and not got[301].accepted
    assert got[100].lang_pred == "en" and got[200].lang_pred == "de" and got[200].score > 0.9 and got[200].accepted and got[11].accepted
    assert not got[300].accepted and got[300].lang_pred in ("de", "en")
    kept = language.accepted_only(docs)
    assert kept.columns == docs.columns and {300, 301, 3, 4} & {r.doc_id for r in kept.collect()} == set()
    nothing = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identified(docs, nothing).collect()} == {"und"} and language.identified(docs.limit(0), models).count() == 0


def test_attention_gradients():
    draw = np.random.default_rng(1)
    bags = [draw.normal(size=(k, attention.FEATURES)) for k in (1, 3, 5)]
    y = np.array([0.0, 1.0, 1.0])
    model = attention.fit(bags, y)
    x, starts = np.concatenate(bags), np.array([0, 1, 4])

    def loss():
        s = model.forward(x, starts)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for w in model.weights:  # away from the optimum
        model.weights[w] = draw.normal(0, 0.1, model.weights[w].shape)
    found = model.gradients(x, starts, y)
    for name, w in model.weights.items():
        at = tuple(draw.integers(s) for s in w.shape)
        change = np.zeros(w.shape)
        change[at] = 1e-5
        model.weights[name] = w + change
        up = loss()
        model.weights[name] = w - change
        down = loss()
        model.weights[name] = w
        assert found[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = attention.train(attention.trained_on(docs), attention.trained_on(labels))
    out = attention.scored(docs, model).join(labels, "doc_id").where(attention.remainder("doc_id", 4) == 2)
    share = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.min("score"), F.max("score")).first()
    assert share[0] > 0.95 and share[1] >= 0 and share[2] <= 1


def test_quality_edges(spark):
    docs = frame(spark, ROWS)
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 1), (9, 0), (12, 0), (13, None), (None, 1)], "doc_id long, quality int")
    got = attention.scored(docs, attention.train(docs, labels)).collect()
    assert len(got) == len(ROWS) and {r.score for r in got if r.doc_id in (3, 4)} == {0.0} and all(0 <= r.score <= 1 for r in got)
    none = attention.train(docs, labels.limit(0))
    assert none.share == 0.5 and attention.scored(docs.limit(0), none).count() == 0


def brute(ids, x, q, k):
    s = graph_search.cosines(x, x[q][None, :])
    s[ids == ids[q]] = -9
    return [int(ids[i]) for i in np.lexsort((ids, -s))[:k]]


def test_graph_search_recall_and_ties(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "SHARD", 300)
    draw = np.random.default_rng(4)
    x = draw.normal(size=(900, 24)).astype(np.float32)
    x[100:160] = x[50]  # many copies of a query
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)] + [(5000, None, 1), (5050, [0.0] * 24, 1), (5100, [float("nan")] * 24, 1), (None, [1.0] * 24, 1), (5150, [], 1), (0, [float(v) for v in x[0]], 1)]
    rows += [(6000 + i, [1.0, float(i)], 1) for i in range(0, 100, 25)]
    got = graph_search.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert set(by) == {*range(0, 900, 50), 6000, 6050} and by[6000] == [6025, 6050, 6075]
    hits = sum(len(set(by[q]) & set(brute(np.arange(900), x.astype(float), q, 5))) for q in range(0, 900, 50))
    assert hits >= 0.9 * 5 * 18 and by[50] == [100, 101, 102, 103, 104]
    assert graph_search.neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
