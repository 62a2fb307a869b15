import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import ngram_jaccard as J


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 10**6), st.sampled_from([80, 85]))
def test_linking_sets_share_the_coarse_tokens_they_need(n, lost, won, seed, percent):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    b = np.unique(np.concatenate([a[min(lost, n - 1) :], rng.integers(0, 2**64, won, dtype=np.uint64)]))
    if J.links(a, b, percent):
        x, need_a = J.coarse_tokens(a, percent)
        y, need_b = J.coarse_tokens(b, percent)
        assert len(np.intersect1d(x, y)) >= max(need_a, need_b) >= 1


def _rows(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    line = " ".join(word() for _ in range(40))
    seeds = [" ".join(word() for _ in range(rng.choice([5, 12, 30, 80, 200]))) for _ in range(max(2, n // 12))]
    rows = []
    for i in range(n):
        ws = rng.choice(seeds).split(" ")
        for _ in range(rng.randint(0, 1 + len(ws) // 40)):
            ws[rng.randrange(len(ws))] = word()
        if rng.random() < 0.2:
            ws += line.split(" ")
        if rng.random() < 0.1:
            ws = [w.upper() for w in ws]
        rows.append((i, rng.choice([" ", "\n"]).join(ws)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "one two"), (n + 4, "One  two"), (None, rows[0][1]), (3, rows[3][1]), (5, rows[9][1]), (None, "only null here it is")]
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    for seed in (1, 2):
        rows = _rows(150, seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "doc_id AS cls", "text AS shard")
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.jaccard_components(df).collect())
        assert got == brute(rows)


def test_chain_and_empty(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(100 - k, " ".join(base[4 * k : 4 * k + 120])) for k in range(20)]  # neighbours link, ends do not
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {81}
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_one_takes_five_words_and_four_fifths(spark):
    base = [f"w{i}" for i in range(100)]
    near = base[:90] + [f"x{i}" for i in range(10)]  # 86 of 106 shingles
    far = base[:80] + [f"y{i}" for i in range(20)]
    rows = [(3, " ".join(near), "k"), (1, " ".join(base), "k"), (7, " ".join(far), "k"), (8, None, "k"), (9, "", None)]
    out = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert out.columns == ["doc_id", "text", "source"] and sorted(r.doc_id for r in out.collect()) == [1, 7, 8, 9]


def test_a_large_family_below_the_threshold(spark, monkeypatch):
    """1,500 texts of equal length, all alike, few of which link; in one tile and in many."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(1500):
        ws = list(base)
        for _ in range(4):
            ws[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(ws)))
    rows += [(1500 + i, t.replace("w3 ", "changed ")) for i, (_, t) in enumerate(rows[:40])]
    expected = sorted((str(d), n, c) for d, n, c in _components_by_elements(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for least, most in ((1 << 20, 8 << 20), (1 << 15, 1 << 16)):
        monkeypatch.setattr(J, "BLOCK_LEAST", least)
        monkeypatch.setattr(J, "BLOCK_MOST", most)
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.jaccard_components(df).collect())
        assert got == expected


def _components_by_elements(rows):
    """As brute, with a matrix of elements."""
    sets = [sets_of(t) for _, t in rows]
    names = {e: i for i, e in enumerate(sorted({e for s in sets for e in s}))}
    m = np.zeros((len(rows), len(names)), np.float32)
    for i, s in enumerate(sets):
        m[i, [names[e] for e in s]] = 1
    n = m.sum(1)
    both = m @ m.T
    near = 100 * both >= 85 * (n[:, None] + n[None, :] - both)
    root = np.arange(len(rows))
    for _ in range(len(rows)):
        new = np.where(near, root[None, :], len(rows)).min(1)
        if (new == root).all():
            break
        root = new
    return [(d, len(s), str(r)) for (d, _), s, r in zip(rows, sets, root, strict=True)]


def test_many_families_share_a_token(spark, monkeypatch):
    monkeypatch.setattr(J, "MANY", 2)
    rows = _rows(150, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.jaccard_components(df).collect()) == brute(rows)


def test_open_groups_finds_what_connects():
    rng = np.random.default_rng(3)
    seeds = [np.unique(rng.integers(0, 2**48, 60, dtype=np.uint64)) for _ in range(6)]
    sets = []
    for i in range(200):
        s = seeds[i % 6]
        sets.append(np.unique(np.concatenate([rng.permutation(s)[rng.integers(0, 9) :], rng.integers(0, 2**48, rng.integers(0, 4), dtype=np.uint64)])))
    for side in (np.zeros(200, np.int32), (np.arange(200) % 5 == 0).astype(np.int32)):
        def roots(pairs):
            r = np.arange(200)
            for i, j in pairs:
                r[r == r[i]] = r[j]
            return np.unique(r, return_inverse=True)[1].tolist()

        every = [(i, j) for i in range(200) for j in range(i) if J.links(sets[i], sets[j]) and (not side.any() or side[i] != side[j])]
        some = J.open_groups(sets, np.arange(200), side, 85)
        assert set(some) <= {*every, *((j, i) for i, j in every)} and len(some) < 200
        a, b = roots(every), roots(some)
        assert len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))
