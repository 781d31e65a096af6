"""Quality rules, mixing and URL filters against plain Python."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as some

from riskloom.llm import mixing, quality_rules, reputation
from tests.llm.fixtures import ROWS, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    more = [(20 + i, t, "en", "s1") for i, t in enumerate(["a b c a b c", "a a a a", "x\nx\n\n x\nx", "a b c d a b", "<#\n|$&%*>\n<#", "x\r\ny\r\nx\r\n", "é \U0001f389 é", "a b c"])]
    rows = [r for r in ROWS if r[0] is not None] + more
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.measures(frame(spark, rows)).collect())
    assert got == Counter((r[0], *plain_measures(r[1])) for r in rows)


def test_hosts_take_their_documents_along(spark):
    good = [(i, prose(i, 60), "en", f"good{i % 5}") for i in range(200)]
    bad = [(1000 + i, "too short" if i % 10 else prose(i, 60), "en", "bad") for i in range(200)]
    lone = [(2000, "short", "en", "lone"), (2001, None, "en", None), (2002, prose(1, 60), "en", None)]
    out = {r.doc_id: r for r in quality_rules.judged(frame(spark, good + bad + lone)).collect()}
    assert len(out) == 403 and all(out[i].kept for i in range(200))
    assert not any(out[1000 + i].kept for i in range(200)) and not out[1000].base_failed
    assert not out[2000].kept and not out[2001].kept and out[2002].kept
    assert quality_rules.judged(frame(spark, [])).count() == 0


def test_targets():
    sizes = [("a", 100), ("b", 100), ("c", 100), (None, 100), ("z", 0)]
    got = mixing.targets(sizes)
    # weights: a 5, b 2, c 1, z 5, null 2; 600 words: z stops at 0, a at 200, then 400 over b, c and null by 2, 1, 2.
    assert got == pytest.approx({"a": 200, "b": 160, "c": 80, "z": 0, None: 160})
    assert sum(got.values()) == pytest.approx(600)
    assert mixing.targets([]) == {} and mixing.targets([("a", 10)]) == {"a": 15.0}


@settings(max_examples=60, deadline=None)
@given(some.lists(some.tuples(some.floats(0, 1), some.integers(1, 50), some.floats(0, 1, exclude_max=True)), max_size=40))
def test_pivot_keeps_the_words(items):
    x, s, u = (np.array(c, float) for c in zip(*items)) if items else (np.zeros(0),) * 3
    out, left = mixing.pivot(x, s, u)
    whole = [v for i, v in enumerate(out) if i != left]
    assert all(v in (0, 1) for v in whole) and (out * s).sum() == pytest.approx((x * s).sum(), abs=1e-5)
    assert left < 0 or 0 < out[left] < 1


def test_pivot_is_fair():
    draw = np.random.default_rng(3)
    x, s = np.array([0.3, 0.5, 0.7, 0.9]), np.array([10, 1, 5, 3])
    total = np.zeros(4)
    for _ in range(4000):
        total += mixing.pivot(x, s, draw.random(4))[0]
    assert total / 4000 == pytest.approx(x, abs=0.03)


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 16)
    monkeypatch.setattr(mixing, "FAN", 4)
    rows = [(i, prose(i, 1 + i % 37), "en", ["hot", "hot", "b", "c", None][i % 5]) for i in range(600)] + [r for r in ROWS if len(r[1] or "") < 5000]
    docs = frame(spark, rows)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    by, target = defaultdict(int), {}
    source = defaultdict(set)
    for r in rows:
        source[r[0]].add(r[3])
    biggest = max(len(WORD.findall(r[1] or "")) for r in rows)
    sums = defaultdict(lambda: [0, 0.0])
    for r in out:
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sums[r.target][0] += r.taken
    assert all(abs(taken - t) <= biggest for t, (taken, _) in sums.items()) and by == {} and target == {}
    assert sum(t for t in sums) == pytest.approx(1.5 * sum(r.size for r in out))
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r.copies for r in out)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_rows_with_one_hash_in_common_stay_apart(spark, monkeypatch):
    """If one of the two hashes were the same for all rows, no document would be lost or taken for another."""
    again = mixing._spots
    monkeypatch.setattr(mixing, "_spots", lambda: (F.lit(7).cast("long"), again()[1]))
    rows = [(i % 50 if i % 7 else None, prose(i, 20), "en", "s") for i in range(200)]
    docs = frame(spark, rows)
    got = mixing.mixed(docs).collect()
    want = {r.again: r.copies for r in mixing.mix(docs).collect()}
    assert len(want) == 200 and len(got) == sum(want.values()) and len({r.text for r in got}) == sum(c > 0 for c in want.values())


URLS = [
    ("http://A.Net/x", "a.net", "/x", "net/", "block"), ("https://net", "net", "", None, None), ("http://x.example.net/en/1?q#f", "x.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/en", "example.net", "/en", "net/", "block"), ("ftp://q.example.com/de/", "q.example.com", "/de/", "example.com/de/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, None), ("http://x.org/fr/3", "x.org", "/fr/3", "org/fr/", "allow"), (None, "", "", None, "allow"),
    ("no scheme", "", "", None, "allow"), ("http://?q", "", "", None, "allow"), ("http://x.org#://y", "x.org", "", None, None), ("a\nb://H.org/p\nq?z", "h.org", "/p\nq", None, None),
]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u[0], 1, "x") for i, u in enumerate(URLS)] + [(0, URLS[0][0], 1, "x")], "page_id long, url string, n int, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = reputation.judged(pages, labels).collect()
    assert len(out) == len(URLS) + 1
    for r in out:
        _, host, path, rule, verdict = URLS[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")
    assert reputation.judged(pages.limit(0), labels).count() == 0


def test_reputation_borrows_from_the_levels_above(spark):
    rows, labels, n = [], [], 0
    for host, size, bad in [("bad.evil.com", 60, 58), ("new.evil.com", 0, 0), ("ok.good.org", 80, 2), ("one.good.org", 1, 1), ("lone.evil.com", 40, 38)]:
        for i in range(size):
            n += 1
            rows.append((n, f"http://{host}/en/{n}.html"))
            labels.append((n, 0 if i < bad else 1, 0))
    rows += [(9001, "http://new.evil.com/en/x"), (9002, "http://one.good.org/en/x")]
    labels += [(1, None, None), (None, 0, 0), (2, 1, 0)]
    out = {r.page_id: r.verdict for r in reputation.judged(
        spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert out[1] == "block" and out[9002] == "allow" and out[70] == "allow" and out[n] == "block"
    assert math.isfinite(reputation.Z)
