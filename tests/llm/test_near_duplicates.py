"""SimHash and passages against brute force."""

import random
import string

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import components, passages, simhash
from tests.llm.fixtures import PASSAGE, ROWS, frame, prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_fingerprint(text):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, linked):
    group = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    return group


def test_simhash_against_brute_force(spark):
    draw = random.Random(5)
    words = prose(20, 400).split()
    edited = [(100 + i, " ".join(w if draw.random() > 0.01 else "edit" for w in words), "en", "s") for i in range(30)]
    rows = ROWS + edited
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    marks = {r[0]: plain_fingerprint(r[1]) for r in rows if r[0] is not None}
    ids = sorted(marks)
    linked = [(a, b) for a in ids for b in ids if a < b and (marks[a] ^ marks[b]).bit_count() <= 2]
    groups = plain_groups(ids, linked)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got if r.doc_id is not None} == {(d, f"{m:016x}", groups[d]) for d, m in marks.items()}
    assert {r.component_id for r in got if r.doc_id is None} == {1, None}


def test_links_of_crowded_cells(spark):
    draw = random.Random(8)
    base = draw.getrandbits(64)
    marks = {base ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(400)}
    marks |= {draw.getrandbits(64) for _ in range(200)} | {base}
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    found = simhash.links(spark.createDataFrame([(m,) for m in signed], "mark long")).collect()
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in found)
    assert plain_groups(signed, [(r.a, r.b) for r in found]) == plain_groups(signed, near)


def test_cells_are_not_broadcast(spark):
    """Their number is 33 times that of the fingerprints, whose table is small enough to be sent to all tasks."""
    draw = random.Random(9)
    marks = sorted({draw.getrandbits(64) - (1 << 63) for _ in range(4000)})
    marks += [m ^ 1 for m in marks[:50] if m ^ 1 not in set(marks)]
    nodes = simhash.stored(spark.createDataFrame([(m,) for m in marks], "mark long"), "test-nodes")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "200k", "spark.sql.maxBroadcastTableSize": "4m"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {(r.a, r.b) for r in simhash.links(nodes).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    every = np.array(marks).view(np.uint64)
    near = {(a, marks[j]) for a, x in zip(marks, every) for j in np.flatnonzero(np.bitwise_count(every ^ x) <= 2) if a < marks[j]}
    assert len(near) >= 50 and found == near


def test_one_of_each_keeps_leaders_and_columns(spark):
    docs = frame(spark, ROWS)
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert 1 in kept and 2 not in kept and kept.count(3) == 1 and 4 not in kept and kept.count(None) == 2
    assert simhash.one_of_each(docs.limit(0)).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 60), (60, 55), (55, 50), (None, 3)]])
def test_components(spark, edges):
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    clean = [e for e in edges if None not in e and e[0] != e[1]]
    assert got == plain_groups({n for e in clean for n in e}, clean)


def test_passages_are_found_cut_and_kept_once(spark):
    docs = frame(spark, ROWS)
    found = {r.doc_id: r for r in passages.documents_with_repeats(docs).collect()}
    assert set(found) == {1, 2, 8, 9} and found[9].removed and found[9].first_docs == [8] and not found[8].removed and not found[1].removed
    out = passages.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    texts = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS) and texts[8].text == dict((r[0], r[1]) for r in ROWS)[8]
    left = texts[9].text.split()
    assert left[:20] == ROWS[9][1].split()[:20] and texts[9].n_chars == len(texts[9].text) and " ".join(left).count(PASSAGE[:200]) == 0
    assert all(texts[r[0]].text == r[1] for r in ROWS if r[0] not in (None, 2, 9))
    assert passages.documents_with_repeats(docs.limit(0)).count() == 0


def test_every_long_shared_run_is_found(spark):
    rows = []
    for i in range(40):
        at, size = 3 * i, 51 + i % 30
        run = prose(100 + i, size)
        rows += [(2 * i, prose(300 + i, at + 5) + " " + run + " " + prose(400 + i, 30), "en", "s"), (2 * i + 1, prose(500 + i, 45) + "\n" + run + " " + prose(600 + i, at), "en", "s")]
    rows += [(1000 + i, prose(900 + i, 200), "en", "s") for i in range(20)]
    found = {r.doc_id for r in passages.documents_with_repeats(frame(spark, rows)).collect()}
    assert found == set(range(80))


def test_long_shared_runs_go_whole(spark):
    rows, want = [], {}
    for i, size in enumerate([51, 52, 55, 60, 60, 75, 99, 100]):
        run = " ".join(f"w{i}x{j}" for j in range(size))
        rows += [(2 * i, prose(300 + i, 7 * i) + " " + run + " " + prose(400 + i, 30), "en", "s"), (2 * i + 1, prose(500 + i, 45) + "\n" + run + " " + prose(600 + i, i), "en", "s")]
        want |= {2 * i: (size, 0), 2 * i + 1: (size, size)}
    # A third document shares the middle only: the later two still share all of it.
    run = [f"y{j}" for j in range(70)]
    rows += [(50, prose(700, 40) + " " + " ".join(run[20:60]) + " " + prose(701, 40), "en", "s")]
    rows += [(51 + i, prose(702 + i, 40) + " " + " ".join(run) + " " + prose(704 + i, 40), "en", "s") for i in range(2)]
    docs = frame(spark, rows)
    found = {r.doc_id: (r.repeated_words, r.removed_words) for r in passages.documents_with_repeats(docs).collect()}
    assert {k: found[k] for k in want} == want
    texts = {r.doc_id: r.text for r in passages.without_repeats(docs).collect()}
    given = {r[0]: r[1] for r in rows}
    for i in range(8):
        assert texts[2 * i] == given[2 * i]
        assert texts[2 * i + 1].split() == [w for w in given[2 * i + 1].split() if not w.startswith(f"w{i}x")]
    if 50 in found:
        assert texts[50] == given[50]
    assert found[52] == (70, 70) and not any(w in texts[52].split() for w in run)


def test_short_documents_alone_in_their_partitions(spark):
    for size in (32, 40, 51):
        text = prose(800 + size, size)
        apart = frame(spark, [(0, text, "en", "s")]).union(frame(spark, [(1, text, "en", "s")]))
        together = passages.documents_with_repeats(apart.coalesce(1)).collect()
        assert sorted(passages.documents_with_repeats(apart).collect()) == sorted(together)
        assert len(together) == 2 or size < 51


def test_similar_paragraphs_link_at_the_threshold(spark):
    words = prose(7, 200).split()
    docs = [(0, " ".join(words), "en", "s"), (1, " ".join(words), "en", "s")]
    base = {r.doc_id: r.place for r in passages.paragraphs(frame(spark, docs)).limit(1).collect()}
    place = next(iter(base.values()))
    for offset, near in ((passages.PARAGRAPH - 1, True), (passages.PARAGRAPH - 4, False)):
        edited = list(words[place:place + passages.PARAGRAPH])
        edited[offset] = "changed"
        a, b = ({tuple(x[i:i + 5]) for i in range(passages.SHINGLES)} for x in (words[place:place + passages.PARAGRAPH], edited))
        assert (len(a & b) / len(a | b) >= 0.8) == near
        memory = passages._WordHash()
        one = passages._Paragraphs([" ".join(words[:place] + list(words[place:place + 21]) + words[place + 21:]).encode()], memory)
        two = passages._Paragraphs([" ".join(words[:place] + edited + words[place + 21:]).encode()], memory)
        i, j = (np.flatnonzero(p.place == place) for p in (one, two))
        if len(i) and len(j):
            assert bool(set(one.deletions(i).ravel().tolist()) & set(two.deletions(j).ravel().tolist())) == near


def test_words_are_hashed_all_at_once():
    long = "".join(map(str, range(40)))
    texts = ["", None, "One", " \x0b\x0c two\x1c x\x85", "\u00c4\u00e9 " + " ".join(long[:n] for n in range(1, 70)), "ab", "CD", " \t\n\r"]
    for column in (pa.array(texts).slice(1), pa.array(texts, pa.large_string()), [None if t is None else t.encode() for t in texts], [], [None]):
        rows = [t.encode() if isinstance(t, str) else t for t in (column.to_pylist() if isinstance(column, pa.Array) else column)]
        words = [(t or b"").lower().split() for t in rows]
        hashes, sizes = passages._WordHash()(column)
        assert sizes.tolist() == [len(w) for w in words]
        assert hashes.tolist() == [xxhash.xxh64_intdigest(w) for x in words for w in x]


def test_texts_that_nothing_is_wanted_of_stay_out(spark, monkeypatch):
    docs = spark.range(-500, 4500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    wanted = spark.createDataFrame([(i,) for i in range(-500, 4500, 100)] * 2, "doc_id long")
    want = set(range(-500, 4500, 100))
    found = [r.doc_id for r in passages._among(docs, wanted).collect()]
    assert want <= set(found) and len(found) == len(set(found)) < 60
    assert passages._among(docs, wanted.limit(0)).count() == 0
    monkeypatch.setattr(passages, "MAP_WORDS", 2)  # too small a map lets more through and loses nothing
    assert want <= {r.doc_id for r in passages._among(docs, wanted).collect()}


def test_cut_keeps_the_rest(spark):
    text = "  a b\nc  d e\t" + " ".join(map(str, range(30))) + " z"
    assert passages.cut(text, [(2, 2)]) == "  a b\ne\t" + " ".join(map(str, range(30))) + " z"
    assert passages.cut(text, [(5, 100)]) == "  a b\nc  d e\t"
    assert passages.cut(text, []) == text and passages.cut("a", [(0, 1)]) == ""


def test_runs_beside_paragraphs_against_brute_force(spark):
    """Every window against every other of its class, on texts that share runs of all lengths and part at any word."""
    import random

    draw = random.Random(7)
    base = [f"w{draw.randrange(9999)}" for _ in range(160)]
    texts = []
    for i in range(60):
        a = draw.randrange(0, 60)
        words = base[a:a + draw.randrange(50, 100)]
        for _ in range(draw.randrange(0, 3)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(3)}"
        texts.append((i, " ".join([f"y{draw.randrange(4)}" for _ in range(draw.randrange(0, 6))] + words), "en", "s"))
    docs = frame(spark, texts)
    members = passages.paragraphs(docs).select("doc_id", "place", "content", F.col("content").alias("passage"))
    windows = passages.stored(passages._windows(docs, members), "test-windows")
    got = {(r.doc_id, r.place): (r.before, r.after, r.gone_before, r.gone_after) for r in passages._extents(docs, windows).collect()}
    words = {i: t.lower().split() for i, t, *_ in texts}
    rows = [(r.doc_id, r.place, r.passage) for r in members.collect()]
    sides = {}
    for i, at, passage in rows:
        sides.setdefault((passage, 0), []).append((i, at, words[i][max(0, at - 30):at][::-1]))
        sides.setdefault((passage, 1), []).append((i, at, words[i][at + 21:at + 51]))

    def common(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    wrong = []
    for i, at, passage in rows:
        want = []
        for smaller in (False, True):
            for side in (0, 1):
                own = next(w for j, a, w in sides[passage, side] if (j, a) == (i, at))
                want.append(max([common(own, w) for j, _, w in sides[passage, side] if j != i and (not smaller or j < i)], default=0))
        if got.get((i, at), (0, 0, 0, 0)) != tuple(want):
            wrong.append((i, at, got.get((i, at)), want))
    assert len(rows) > 100 and any(len(x) > 5 for x in sides.values()) and not wrong


def test_plan_does_not_follow_the_data(spark):
    def exchanges(run):
        rows = [(i, prose(300 + i, 20) + " " + run + " " + prose(400 + i, 20), "en", "s") for i in range(6)]
        return passages.documents_with_repeats(frame(spark, rows))._jdf.queryExecution().toString().count("Exchange")

    assert exchanges(prose(1, 52)) == exchanges(prose(2, 600)) < 40
