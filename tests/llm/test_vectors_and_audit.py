"""Vector codes, filter audit and vector near-duplicates against brute force, and their awkward rows."""

import hashlib
from itertools import permutations

import numpy as np
import pytest

from riskloom.llm import filter_audit, vector_codes, vector_duplicates
from tests.llm.fixtures import ROWS, frame

VECTORS = "vec_id long, embedding array<float>, label int, node long, key int, parts string, clump int"


def vectors(spark, rows):
    """``rows``: (vec_id, embedding, label); the other columns clash with names used inside."""
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], c, 1, 2, "x", 3) for i, v, c in rows], VECTORS)


def some_vectors(count, dim=16, seed=5, groups=3, near=0.05):
    """Vectors around a few centres of each label, so that many link and many do not."""
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((groups * 4, dim))
    at = draw.integers(0, len(centres), count)
    spread = np.where(draw.random(count) < 0.7, near, 1.0)
    return [(int(i), np.float32(centres[c] + spread[i] * draw.standard_normal(dim)), int(c % groups)) for i, c in enumerate(at)]


AWKWARD = [
    (900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1), (904, [float("inf")] + [1.0] * 15, 1),
    (905, [], 1), (906, [1.0] * 16, None), (907, [1.0] * 16, None), (908, [1.0] * 8, 1), (None, [2.0] * 16, 1), (909, [2.0] * 16, 1), (909, [2.0] * 16, 1),
    (910, [3e38] * 16, 1), (911, [1e-40] * 16, 1)]


# --- codes ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_what_a_full_search_finds(seed):
    draw = np.random.default_rng(seed)
    top = [3, 40, 2000, 1 << 25, 1 << 25, 7][seed]
    points = draw.integers(-top, top + 1, (256, 4 + seed))
    points[100:130] = points[7]  # equal entries
    if seed == 5:
        points[:] = points[0]
    queries = np.concatenate((draw.integers(-top, top + 1, (3000, points.shape[1])), points[::3]))
    index, far = vector_codes.nearest(vector_codes.build(points), points, queries)
    gaps = queries[:, None, :] - points[None, :, :]
    exact = (gaps * gaps).sum(axis=2)
    assert (index == exact.argmin(axis=1)).all() and (far == exact.min(axis=1)).all()


def test_tree_leaves_subtrees_out(monkeypatch):
    draw = np.random.default_rng(1)
    points = np.repeat(draw.integers(-4000, 4000, (16, 16)), 16, axis=0) + draw.integers(-20, 20, (256, 16))
    queries = points[draw.integers(0, 256, 500)] + draw.integers(-5, 5, (500, 16))
    tree, pairs, real = vector_codes.build(points), [], vector_codes.squared
    monkeypatch.setattr(vector_codes, "squared", lambda a, b: pairs.append(len(a) * len(b)) or real(a, b))
    vector_codes.nearest(tree, points, queries)
    assert sum(pairs) < 0.5 * len(queries) * len(points)


def plain_codes(rows):
    """The rule in plain Python: rows (vec_id, embedding, label) that are kept."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, list(map(float, r[1]))))
    whole = [[max(-vector_codes.MOST, min(vector_codes.MOST, int(np.floor(1024 * float(x))))) for x in r[1]] for r in rows]
    w = len(whole[0]) // 4
    books = [[v[p * w:(p + 1) * w] for v in whole[:256]] for p in range(4)]

    def pick(p, v):
        part = v[p * w:(p + 1) * w]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(4):
        chosen = [[pick(p, v)[1] for v in whole] for p in range(4)]
        for p in range(4):
            for i in set(chosen[p]):
                mine = [v[p * w:(p + 1) * w] for v, c in zip(whole, chosen[p]) if c == i]
                books[p][i] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for r, v in zip(rows, whole):
        found = [pick(p, v) for p in range(4)]
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), r[2]))
    sums = {}
    for _, _, e, c in out:
        sums[c] = sums.get(c, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, c, e, sums[lab], digest) for i, c, e, lab in out], key=str)


@pytest.mark.parametrize("count", [5, 320])
def test_codes_follow_the_rule(spark, count):
    good = [(i, v, c if i % 7 else None) for i, v, c in some_vectors(count, 8)]
    good += [(3, good[3][1], 2), (None, good[4][1], 1)]
    bad = [(900, None, 1), (901, [float("nan")] * 8, 1), (902, [None] + [1.0] * 7, 1), (-1, [float("inf")] * 8, 1), (903, [1.0] * 4, 1), (904, [], 1)]
    got = vector_codes.coded(vectors(spark, good + bad).repartition(5)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted([tuple(r) for r in got], key=str) == plain_codes(good)


def test_codes_of_awkward_tables(spark):
    assert vector_codes.coded(vectors(spark, [])).count() == 0
    assert vector_codes.coded(vectors(spark, [(1, None, 1)])).count() == 0
    huge = vector_codes.coded(vectors(spark, [(1, [3e38] * 4, 1), (2, [-3e38] * 4, 1)])).collect()
    assert [(r.code, r.error) for r in sorted(huge)] == [("00000000", 0), ("01010101", 0)]
    assert [r.code for r in vector_codes.coded(vectors(spark, [(1, [1.0, 2.0, 3.0], 1)])).collect()] == ["00000000"]
    assert len({r.code for r in vector_codes.coded(vectors(spark, [(i, [1.0] * 8, None) for i in range(300)])).collect()}) == 1


# --- audit ----------------------------------------------------------------------------------------

def plain_audit(rows, labels):
    import re
    fails, first = [], {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, _, source in rows:
        text = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
               "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and first[text] < i}
        fails.append((source or "", {k for k, v in bad.items() if v}, any(d == i and q == 1 for d, q, _ in labels if i is not None), any(d == i and x == 1 for d, _, x in labels if i is not None)))
    out, sums = [], {}
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for s, name in enumerate(order):
                before = set(order[:s])
                here = [f for f in mine if name in f[1] and not f[1] & before]
                sums[part, name] = sums.get((part, name), 0) + len(here)
                out.append([part, order, s + 1, sum(not f[1] & (before | {name}) for f in mine), len(here), sum(name in f[1] and bool(f[1] & before) for f in mine),
                            sum(f[1] == {name} for f in mine), sum(f[2] for f in here), sum(f[3] for f in here)])
    return sorted((*r, sums[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_counts_every_order(spark):
    rows = ROWS + [(20, ROWS[0][1], "en", "s1"), (21, ROWS[0][1] + " #", "en", ""), (22, "A" * 400, "en", "s2"), (23, None, "en", "s2"), (24, ("ONE two % " * 40), "en", "s3"), (25, ("ONE two % " * 40), "en", "s3")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (20, 1, 1), (4, 1, 1), (None, 1, 1), (24, 1, None), (25, None, 1), (999, 1, 1), (23, 0, 0)]
    table = spark.createDataFrame([(*x, "clash", 1) for x in labels], "doc_id long, quality int, toxic int, part string, n int")
    got = filter_audit.audit(frame(spark, rows).repartition(4), table)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, labels)
    assert filter_audit.audit(frame(spark, rows), table.limit(0)).agg({"good_lost": "sum", "toxic_lost": "sum"}).first()[:] == (0, 0)
    assert filter_audit.audit(frame(spark, []), table).count() == 0


def test_audit_of_one_hot_text_and_source(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same text', concat('text ', id)) AS text", "IF(id % 2 = 0, NULL, '') AS source")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, empty).where("filter_order = 'EABCD'").orderBy("step").collect()
    assert {r.part for r in got} == {""} and [r.removed for r in got] == [999, 2001, 0, 0, 0]


# --- near-duplicates ------------------------------------------------------------------------------

def plain_groups(rows):
    """(vec_id, n_links, component_id) by comparing every pair; rows of one id and vector are one."""
    def usable(v, c):
        return v is not None and c is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    key = lambda r: (r[0] if r[0] is not None else object(), r[2], tuple(map(float, r[1])))
    nodes = list({key(r): r for r in rows if usable(r[1], r[2])}.values())
    unit = {len(r[1]): None for r in nodes}
    for d in unit:
        x = np.array([np.asarray(r[1], np.float64) for r in nodes if len(r[1]) == d])
        x /= np.abs(x).max(axis=1, keepdims=True)
        unit[d] = iter(x / np.linalg.norm(x, axis=1, keepdims=True))
    x = [next(unit[len(r[1])]) for r in nodes]
    links = [[j for j in range(len(nodes)) if j != i and nodes[i][2] == nodes[j][2] and len(x[i]) == len(x[j]) and float(x[i] @ x[j]) >= 0.93] for i in range(len(nodes))]
    low = list(range(len(nodes)))
    for i in range(len(nodes)):
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        low[i] = min((nodes[j][0] for j in group if nodes[j][0] is not None), default=None)
    told = {(r[0], r[2], tuple(map(float, r[1]))): (len(links[i]), low[i]) for i, r in enumerate(nodes)}
    return sorted([(r[0], *(told[r[0], r[2], tuple(map(float, r[1]))] if usable(r[1], r[2]) else (0, r[0]))) for r in rows], key=str)


def groups_of(spark, rows):
    got = vector_duplicates.near_duplicates(vectors(spark, rows).repartition(5)).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str)


def test_near_vectors_against_all_pairs(spark):
    rows = some_vectors(400, near=0.04) + AWKWARD
    assert groups_of(spark, rows) == plain_groups(rows)


def test_near_vectors_in_full_buckets(spark, monkeypatch):
    """Pieces and clumps far below the production sizes: many groups a bucket, and the same links."""
    monkeypatch.setattr(vector_duplicates, "PIECE", 16)
    rows = some_vectors(500, groups=1, near=0.09, seed=8) + AWKWARD + [(1000 + i, v, 1) for i, (_, v, _) in enumerate(some_vectors(60, near=0.01, seed=9))]
    want = plain_groups(rows)
    assert groups_of(spark, rows) == want
    monkeypatch.setattr(vector_duplicates, "leaders", lambda nodes, count: [])
    assert groups_of(spark, rows) == want


def test_recall_at_the_threshold(spark):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        a, b = draw.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = 0.9305 if i % 2 else 0.929
        rows += [(2 * i, a, 1), (2 * i + 1, cosine * a + np.sqrt(1 - cosine ** 2) * b, 1)]
    got = {i: n for i, n, _ in groups_of(spark, rows)}
    found = sum(got[2 * i] for i in range(1, 1500, 2))
    assert found >= 0.97 * 750 and not any(got[2 * i] for i in range(0, 1500, 2))


def test_near_vectors_of_awkward_tables(spark):
    assert groups_of(spark, []) == []
    assert groups_of(spark, [(1, None, 1), (2, [1.0], None)]) == [(1, 0, 1), (2, 0, 2)]
    same = [(i, [1.0, 2.0], 1) for i in range(300)]
    assert set(groups_of(spark, same)) == {(i, 299, 0) for i in range(300)}


def test_a_clump_is_never_compared(spark):
    """A group of near copies with most of the rows adds no pairs of pieces."""
    draw = np.random.default_rng(4)
    centre = draw.standard_normal(32)
    rows = [(i, centre + 0.02 * draw.standard_normal(32), 1) for i in range(600)] + [(600 + i, draw.standard_normal(32), 1) for i in range(200)]
    nodes = vectors(spark, rows).selectExpr("vec_id AS node", "CAST(label AS STRING) AS label", "embedding", "size(embedding) AS dim", "1L AS copies", "vec_id AS first")
    found = vector_duplicates.leaders(nodes, 800)
    assert len(found) == 1
    schema = "node long, label string, dim int, embedding array<float>, copies long, first long, signs array<int>, clump int"
    signed = nodes.select("node", "label", "dim", "embedding", "copies", "first").mapInArrow(vector_duplicates._signed(10, 20, found), schema)
    assert signed.where("clump = 0").count() == 600
    met = vector_duplicates._met(signed)
    clumped = met.join(signed.select("node", "clump"), "node").where("clump = 0 and left = right")
    assert clumped.count() == 0
