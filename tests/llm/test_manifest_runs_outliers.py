"""Merkle proofs, periodic runs and robust outliers against plain versions, and on frames of odd rows."""

import math
import random
import sys
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import brute  # noqa: E402

from tidemark.llm import common as C  # noqa: E402
from tidemark.llm import merkle, periodic, quality, queries  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    C.ship(spark)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return [r.asDict() for r in C.documents(spark, sf_dir).collect()]


CLASH = ["leaf", "root", "proof", "block", "tree", "_part", "n_words", "runs", "collapsed_text", "base_failed", "kept", "distance", "x0", "m0", "_q_text", "grp", "a.b c"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with the results' names."""
    long_ = " ".join(f"w{k % 977} x{k % 13}" for k in range(40_000))
    data = [(None, "same text " * 40, None, None, None), (1, None, "en", "a", 0), (None, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "", 4),
            (4, long_, "en", "é", len(long_)), (5, "b c\n" * 30, "de", "a", 90), (5, "b c\n" * 30, "de", "a", 90), (6, "x y z", None, "b", 5), (6, "x y", None, "b", 3), (-7, "A a A a A a A a", "fr", None, 15)]
    return spark.createDataFrame([(*r, *[None] * len(CLASH)) for r in data], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))


# 11


def check_merkle(found, rows):
    want = defaultdict(list)
    for r, leaf, subroot, root, proof in brute.merkle(rows, merkle.FIELDS):
        want[r["doc_id"], leaf].append((subroot, root, brute.sha(proof)))
    got = defaultdict(list)
    for r in found:
        got[r.doc_id, r.leaf].append((r.subroot, r.root, r.proof_sha256))
    assert {k: sorted(v) for k, v in want.items()} == {k: sorted(v) for k, v in got.items()}


def test_merkle_equals_plain(spark, sf_dir, rows):
    found = queries.op11_merkle(spark, sf_dir).collect()
    check_merkle(found, rows)
    text = {r["doc_id"]: r["text"] for r in rows}
    for r in found:
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and text[r.doc_id] is not None and brute.lower(text[r.doc_id]) != text[r.doc_id]
        assert r.verified == (not changed) and (r.folded_root == r.root) == r.verified


def test_merkle_odd_rows(odd):
    check_merkle(merkle.digests(odd).collect(), [r.asDict() for r in odd.collect()])
    for some in (odd.limit(0), odd.filter("doc_id = 4")):
        check_merkle(merkle.digests(some).collect(), [r.asDict() for r in some.collect()])
    assert merkle.build(odd.limit(0)).root().collect() == []


def test_merkle_many_sources(spark):
    """More sources than fit in one run, of one to sixty rows, in a block and across blocks."""
    data = [{"doc_id": d, "text": f"t{d}", "lang": "x", "source": f"s{d % 400 if d % 3 else 0}", "n_chars": d} for d in range(3000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    check_merkle(merkle.digests(docs).collect(), data)


def test_merkle_proofs_of_some_leaves(spark, rows):
    """A multiproof of scattered leaves gives the same proofs; a changed leaf, proof or place doesn't lead to the root."""
    docs = spark.createDataFrame([(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in rows], "doc_id long, source string, lang string, n_chars long, text string")
    made = merkle.build(docs)
    whole = {r.leaf: r.proof for r in merkle.prove(made).collect()}
    some = merkle.prove(made, made.leaves.filter("doc_id % 7 = 0")).collect()
    assert some and all(whole[r.leaf] == r.proof for r in some)
    root = made.root().first().root
    for r in some[:20]:
        assert merkle.fold(r.leaf, r.proof, r.slots, r.widths) == root
        assert merkle.fold(brute.sha("other"), r.proof, r.slots, r.widths) != root
        assert merkle.fold(r.leaf, brute.sha("other") + r.proof[64:], r.slots, r.widths) != root


def test_merkle_asks_for_the_least():
    """Nothing is asked for that other leaves give; neighbouring leaves ask for a handful."""
    assert [x.tolist() for x in merkle.missing(np.arange(256), 256)] == [[], []]
    assert [len(x) for x in merkle.missing(np.arange(4096), 65536)] == [0, 0, 0, 15]
    assert [x.tolist() for x in merkle.missing(np.array([0, 1, 17]), 18)] == [[*range(2, 16), 16], []]
    assert merkle.missing(np.array([0]), 1) == []


# 12


def words_of(text):
    return brute.BLANK_FREE.findall(text or "")


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_equal_plain_on_random_words():
    pick = random.Random(5)
    some = lambda letters, n: [pick.choice(letters) for _ in range(n)]
    texts = [None, "", " \t"]
    for _ in range(1500):
        texts.append(" ".join(some("ab", pick.randrange(50))))
        texts.append("\n".join(some("abc", pick.randrange(4)) + some("abc", pick.randrange(1, 7)) * pick.randrange(1, 12) + some("abc", pick.randrange(4))))
    texts += ["a " * 300, "é " * 6, "a " * 5, "a b " * 4]
    counts, runs, kept = (x.to_pylist() for x in periodic._slice(pa.array(texts, pa.string())))
    for t, n, r, k in zip(texts, counts, runs, kept, strict=True):
        w = words_of(t)
        want = brute.periodic_runs(w)
        assert (n, [tuple(x.values()) for x in r], k) == (len(w), want, brute.collapsed(w, want))


def test_runs_of_long_texts():
    one = " ".join(["a"] * 30_000)
    two = " ".join([f"x{k}" for k in range(5000)] * 7)
    assert [[tuple(x.values()) for x in r] for r in periodic._slice(pa.array([one, two]))[1].to_pylist()] == [[(0, 30_000, 1)], [(0, 35_000, 5000)]]


def test_runs_query_equals_plain(spark, sf_dir, rows):
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for r in rows:
        w = planted(r["doc_id"], words_of(r["text"]))
        if len(w) > 3000:
            continue
        runs = brute.periodic_runs(w)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        assert tuple(found[r["doc_id"]])[1:] == (len(runs), *best, milli, brute.sha("".join("%d,%d,%d\n" % x for x in runs)), brute.sha(brute.collapsed(w, runs)))


def test_runs_odd_rows(odd):
    found = periodic.find_runs(odd).select("doc_id", "text", "n_words", "runs", "collapsed_text").collect()
    assert len(found) == odd.count()
    for r in found:
        w = words_of(r.text)
        want = [(0, 80, 2)] if r.doc_id is None and w else brute.periodic_runs(w) if len(w) < 1000 else None
        if want is not None:
            assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) == (len(w), want, brute.collapsed(w, want))
    assert periodic.digests(odd).count() == odd.count()
    assert periodic.find_runs(odd.limit(0)).count() == 0 and "a.b c" in periodic.find_runs(odd).columns


# 13


def points_of(stats):
    n, chars, symbols, lines, repeats = stats
    return [math.floor(1024 * v + 0.5) for v in (math.log(n), math.log(chars / n), *[math.log1p(100 * x) for x in (symbols / chars, lines / n, repeats / n)])]


def check_outliers(found, rows):
    stats = {r["doc_id"]: brute.statistics(r["text"]) for r in rows}
    failed = {d: s[0] < 50 or 100 * s[4] > 50 * s[0] for d, s in stats.items()}
    groups = defaultdict(list)
    for r in rows:
        if not failed[r["doc_id"]]:
            groups[r["lang"], r["source"]].append(r["doc_id"])
    pools = defaultdict(list)
    for (lang, source), ids in groups.items():
        pools[(lang, source) if len(ids) >= quality.LEAST_POINTS else (lang,)] += ids
    rest = [d for k, ids in pools.items() if len(k) == 1 and len(ids) < quality.LEAST_POINTS for d in ids]
    pools = {k: ids for k, ids in pools.items() if len(ids) >= quality.LEAST_POINTS} | {(): rest}
    distance = {}
    for ids in pools.values():
        if len(ids) >= quality.LEAST_POINTS:
            d2 = brute.robust_distances([points_of(stats[d]) for d in ids], [f * 1024 for f in quality.FLOORS], quality.STEPS, quality.BINS, quality.HALF, quality.INNER)
            distance |= dict(zip(ids, d2, strict=True))
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[c] for c in quality.STATISTICS) == stats[r.doc_id] and r.base_failed == failed[r.doc_id]
        d2 = distance.get(r.doc_id)
        if r.base_failed or d2 is None:
            assert r.distance is None and r.kept == (not r.base_failed)
        else:
            assert r.distance**2 == pytest.approx(d2, rel=1e-4, abs=1e-6) and (abs(d2 - quality.CUTOFF) < 0.1 or r.kept == (d2 <= quality.CUTOFF))


@pytest.fixture(scope="module")
def grouped(spark):
    """Two groups of their own, a pool of a language, and pools over all; some documents are full of symbols."""
    pick = random.Random(3)
    rows = []
    for d in range(700):
        lang, source = [("en", "a"), ("en", "b"), ("de", f"s{d}"), (None, f"s{d}"), ("fr", None)][min(d % 5 if d % 5 < 3 else 3 + d % 2, 4) if d > 20 else 4]
        n = int(math.exp(pick.gauss(5, 0.6)))
        text = " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randrange(1, 10))) for _ in range(n))
        if d % 29 == 0:
            text = text.replace(" ", "%% ")
        if d % 31 == 0:
            text = "\n".join(["the same line"] * 4) + "\n" + text
        rows.append({"doc_id": d, "text": text, "lang": lang, "source": source})
    return rows, spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, text string, lang string, source string")


@pytest.fixture
def few_steps(monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 2)


@pytest.fixture(scope="module")
def judged(grouped):
    held, quality.STEPS = quality.STEPS, 2
    found = quality.digests(grouped[1]).collect()
    quality.STEPS = held
    return found


def test_outliers_equal_plain(grouped, judged, few_steps):
    rows, _ = grouped
    check_outliers(judged, rows)
    bad = {r["doc_id"] for r in rows if r["doc_id"] % 29 == 0}
    assert all(not r.kept for r in judged if r.doc_id in bad) and sum(not r.kept and not r.base_failed for r in judged if r.doc_id not in bad) == 0


def test_outliers_query(spark, sf_dir, rows, few_steps):
    check_outliers(queries.op13_robust_outliers(spark, sf_dir).collect(), rows)


def test_outliers_do_not_depend_on_partitions_or_ways(grouped, judged, few_steps, monkeypatch):
    """The same rows from another number of partitions and by joins instead of broadcasts; no Python runs."""
    monkeypatch.setattr(quality, "SENT", 0)
    found = quality.digests(grouped[1].repartition(13))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, judged))
    plan = found._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_outliers_odd_rows(odd, few_steps):
    stats = quality.statistics(odd)
    assert "a.b c" in stats.columns and "_q_text" not in stats.columns
    for r in stats.collect():
        assert tuple(r[c] for c in quality.STATISTICS) == brute.statistics(r.text)
    found = quality.judge(stats, quality.fit(stats)).collect()
    assert len(found) == odd.count() and all(r.kept == (not r.base_failed) and r.distance is None for r in found)  # too few for an estimate
    assert quality.digests(odd.limit(0)).count() == 0
