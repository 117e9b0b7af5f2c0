import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import frequency, neardup, together

SHAPE = "entity string, chunks array<string>, extra int, term string"


def nodes(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SHAPE)


def test_frequencies_against_sets(spark):
    rng = random.Random(0)
    rows = [(rng.choice([" Alpha", "alpha ", "Beta", "gamma", None, "hot"] + ["hot"] * 6), [rng.choice(["c1", "c2", "c3", "c4", None]) for _ in range(rng.randrange(0, 5))]) for _ in range(200)]
    rows += [("none", None), ("empty", []), ("nulls", [None])]
    want = {}
    for e, ids in rows:
        if e is not None:
            n, s = want.setdefault(e.strip().lower(), (0, set()))
            kept = [i for i in ids or [] if i]
            want[e.strip().lower()] = (n + len(kept), s | set(kept))
    for salts in (1, 64):
        got = {r["term"]: (r["occurrences"], r["records"]) for r in frequency.term_frequencies(nodes(spark, rows), salts=salts).collect()}
        assert got == {k: (n, len(s)) for k, (n, s) in want.items()}
    marks = {(r["entity"], r["mark"]) for r in frequency.marked_terms(frequency.term_frequencies(nodes(spark, rows))).collect()}
    assert ("empty", "rare") in marks and ("hot", "common") in marks
    assert frequency.term_frequencies(nodes(spark, rows).limit(0)).count() == 0


def test_tail_against_convolution():
    rng = np.random.default_rng(0)
    for q, c in ((rng.uniform(0.001, 0.4, 6), rng.integers(1, 30, 6)), (np.array([0.9, 0.01]), np.array([5, 40])), (np.array([1e-6]), np.array([1000]))):
        pmf = np.array([1.0])
        for x, k in zip(q, c):
            for _ in range(k):
                pmf = np.convolve(pmf, [1 - x, x])
        for n in (0, 1, 2, 5, 9, int(c.sum())):
            mean, log_p = together.tail(q, c.astype(float), n)
            assert mean == pytest.approx((q * c).sum())
            want = pmf[n:].sum()
            if want > 1e-280:
                assert 10**log_p == pytest.approx(want, rel=1e-6)


def test_null_honours_degrees():
    items = pd.DataFrame({"cls": [1, 3, 9], "degree": [1.0, 3.0, 9.0], "count": [30, 20, 4]})
    records = pd.DataFrame({"cls": [2, 6], "degree": [2.0, 6.0], "count": [30, 11]})
    null = together.fit_null(items, records)
    x = np.array([null["x"][c] for c in (1, 3, 9)])
    p = np.outer(x, null["y"]) / (1 + np.outer(x, null["y"]))
    assert np.allclose((p * null["count"]).sum(axis=1), items["degree"], rtol=1e-5)
    assert np.allclose((p * items["count"].to_numpy()[:, None]).sum(axis=0), records["degree"], rtol=1e-5)


def test_null_with_certain_links():
    # of 5 items one is in all 6 records; one record has all items
    items = pd.DataFrame({"cls": [2, 6], "degree": [2.0, 6.0], "count": [4, 1]})
    records = pd.DataFrame({"cls": [2, 5, 1], "degree": [2.0, 5.0, 1.0], "count": [4, 1, 1]})
    null = together.fit_null(items, records)
    x = np.array([null["x"][c] for c in (2, 6)])
    p = np.outer(x, null["y"]) / (1 + np.outer(x, null["y"]))
    assert np.allclose((p * null["count"]).sum(axis=1), items["degree"], rtol=1e-3)
    with pytest.raises(ArithmeticError):
        together.fit_null(pd.DataFrame({"cls": [1, 3, 9], "degree": [1.0, 3.0, 9.0], "count": [30, 20, 4]}), pd.DataFrame({"cls": [2, 6], "degree": [2.0, 6.0], "count": [30, 11]}), rounds=1, slack=1e-9)


def test_null_honours_record_sizes(spark):
    """Where some records hold most items, more meetings are chance than counts alone would say."""
    rows = [("x", [f"b{i}" for i in range(4)] + ["s9"]), ("y", [f"b{i}" for i in range(4)] + ["s8"])]
    rows += [(f"f{k}", [f"b{i}" for i in range(12)]) for k in range(60)] + [(f"g{k}", [f"s{k % 40}"]) for k in range(40)]
    r = together.together(nodes(spark, rows)).filter("a = 'x' and b = 'y'").first()
    assert r["expected"] > 1.5 * r["n_a"] * r["n_b"] / r["n_records"] and r["surprise"] < 2


def test_together_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"E{i % 17} ", [f"c{rng.randrange(40)}" for _ in range(6)]) for i in range(120)] + [("e1", [None, "c1"]), (None, ["c1"]), ("alone", ["c99"])]
    links = {(e.strip().lower(), c) for e, ids in rows if e for c in ids if c}
    of = {}
    for e, c in links:
        of.setdefault(e, set()).add(c)
    want = {(a, b): len(of[a] & of[b]) for a in of for b in of if a < b and of[a] & of[b]}
    for block in (3, 256):
        got = together.together(nodes(spark, rows), block=block).collect()
        assert {(r["a"], r["b"]): r["n_ab"] for r in got} == want
    assert all(0 <= r["q_value"] <= 1 and r["surprise"] >= 0 and r["expected"] > 0 for r in got)
    ordered = sorted(got, key=lambda r: -r["surprise"])
    assert all(x["q_value"] <= y["q_value"] + 1e-9 for x, y in zip(ordered, ordered[1:]))
    n = len({c for _, c in links})
    cut = together.together(nodes(spark, rows), min_together=3).collect()
    assert {(r["a"], r["b"]) for r in cut} == {k for k, v in want.items() if v >= 3}
    whole = {(r["a"], r["b"]): r for r in got}
    assert all(abs(r["q_value"] - whole[r["a"], r["b"]]["q_value"]) < 1e-12 and r["n_records"] == n for r in cut)
    assert together.together(nodes(spark, rows).limit(0)).count() == 0


def test_golay_code_is_perfect():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500)
    index = neardup.near_indices(words)
    assert {len(set(r)) for r in index.tolist()} == {1, 6}
    assert [set(r) for r in index.tolist()] == [set(r) for r in neardup.six_indices(words).tolist()]
    for flips in (1, 2):
        other = words.copy()
        for i in range(len(other)):
            for b in rng.choice(23, flips, replace=False):
                other[i] ^= 1 << int(b)
        near = neardup.near_indices(other)
        assert all(set(a) & set(b) for a, b in zip(index.tolist(), near.tolist()))


def edited(rng, words, share):
    out = list(words)
    for _ in range(int(len(out) * share)):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    rows = []
    for g in range(60):
        base = [f"w{rng.randrange(3000)}" for _ in range(80)]
        rows.append((f"g{g}a", " ".join(base)))
        rows.append((f"g{g}b", " ".join(edited(rng, base, rng.choice((0.02, 0.05, 0.08))))))
    rows += [("dup1", rows[0][1]), ("dup1", rows[0][1]), ("dup2", rows[0][1]), ("short", "too few words"), ("short2", "too few words"), ("empty", ""), ("null", None), (None, "x " * 60), ("long", "word " * 50_000)]
    return rows


def test_near_duplicates_against_all_pairs(spark, copies):
    df = spark.createDataFrame([(*r, "x") for r in copies], "id string, document string, text string")
    texts = {i: neardup.shingles(t, 3) for i, t in copies if i and t and len(neardup.words_of(t)) >= 40}
    want = {(a, b) for a in texts for b in texts if a < b and len(texts[a] & texts[b]) >= 0.6 * len(texts[a] | texts[b])}
    got = {(r["id_a"], r["id_b"]) for r in neardup.near_duplicate_ids(df).collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and ("dup1", "dup2") in got
    groups = {r["id"]: r for r in neardup.near_duplicate_groups(df, width=3, similarity=0.6, guards=1).collect()}
    assert groups["dup1"]["class"] == groups["g0a"]["class"] == "dup1" and groups["dup2"]["copies"] == 3
    assert groups["short"]["class"] == groups["short2"]["class"] == "short" and groups["empty"]["links"] == 0 and "null" not in groups
    assert neardup.near_duplicate_ids(df.limit(0)).count() == 0


def test_guards_change_no_pair(spark, copies):
    df = spark.createDataFrame([(*r, "x") for r in copies], "id string, document string, text string")
    one, two = ({tuple(r) for r in neardup.near_duplicate_ids(df, guards=g).collect()} for g in (1, 2))
    assert one == two
    for similarity in (0.6, 0.8):
        sizes = [neardup.guards_for(n, similarity) for n in (0, 10**5, 10**7, 10**9, 10**12)]
        assert sizes == sorted(sizes) and sizes[0] == 1 and sizes[-1] > 1
        for g in (1, 2, 3):
            assert (1 - neardup.band_chance(similarity, g)) ** neardup.bands_for(similarity, g) <= neardup.MISSED


def test_crowded_keys_lose_no_pair(spark, copies, monkeypatch):
    rng = random.Random(13)
    base = [f"w{rng.randrange(3000)}" for _ in range(80)]
    rows = [(*r, "x") for r in copies] + [(f"crowd{k:02}", " ".join(edited(rng, base, 0.02)), "x") for k in range(40)]
    df = spark.createDataFrame(rows, "id string, document string, text string")
    want = {tuple(r) for r in neardup.near_duplicate_ids(df).collect()}
    assert len(want) > 40 * 39 / 2
    texts = df.select(F.unhex(F.substring(F.sha2("document", 256), 1, 32)).alias("digest"), F.col("document").alias("text")).dropna()
    made = neardup.sketches(texts, 3, 40, 32, 1)
    keyed = made.select("doc", "kinds", "one", "two", "mins").toPandas()
    rows = pd.concat(neardup._keys([keyed], 32, 1)).sort_values("guard")
    cut = [rows.iloc[i : i + 7] for i in range(0, len(rows), 7)]
    pairs = pd.concat(neardup._meet(cut, 0.6))
    assert pairs["q"].notna().all()
    for meeting, crowd in ((4, 200_000), (1024, 5), (4, 5)):
        monkeypatch.setattr(neardup, "MEETING", meeting)
        monkeypatch.setattr(neardup, "CROWD", crowd)
        some = pd.concat(neardup._meet(cut, 0.6))
        alone = some[some["q"].isna()]
        met = {(p, q) for p, q in zip(some["p"], some["q"]) if not pd.isna(q)}
        for _, group in alone.groupby("key"):
            met |= {(p, q) for p in group["p"] for q in group["p"] if p < q}
        assert met >= set(zip(pairs["p"], pairs["q"])) and len(alone)
        again = neardup.near_pairs(texts, made, 3, 0.6, 32, 1)  # the workers have the plain limits, so only the crowd's blocks differ
        assert again.count() == neardup.near_pairs(texts, made, 3, 0.6, 32, 1).count()


def test_components_fail_rather_than_stop(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "x int, y int")
    with pytest.raises(ArithmeticError):
        neardup.components(chain, rounds=1)


def test_components(spark):
    rng = random.Random(2)
    pairs = [(a, b) for a, b in ((rng.randrange(200), rng.randrange(200)) for _ in range(150)) if a != b] + [(300 + i, 301 + i) for i in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["class"] for r in neardup.components(spark.createDataFrame(pairs, "x int, y int")).collect()}
    assert got == {n: find(n) for p in pairs for n in p}


def test_pairs_at_the_threshold_are_found(spark):
    rng = random.Random(11)
    rows = []
    for g in range(400):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        other = base[:30] + [f"n{rng.randrange(10**6)}" for _ in range(22)] + base[52:]  # 24 of 98 shingles differ: 74 of 122 are in both
        rows += [(f"g{g:03d}a", " ".join(base)), (f"g{g:03d}b", " ".join(other))]
    one, two = (neardup.shingles(t, 3) for _, t in rows[:2])
    assert 0.6 <= len(one & two) / len(one | two) < 0.61
    got = {(r["id_a"], r["id_b"]) for r in neardup.near_duplicate_ids(spark.createDataFrame(rows, "id string, document string")).collect()}
    assert got <= {(f"g{g:03d}a", f"g{g:03d}b") for g in range(400)} and len(got) >= 399
