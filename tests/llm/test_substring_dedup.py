import hashlib
import random

import numpy as np
import pytest

from tessera.llm import substring_dedup as S

NULL = S.NULL_ID


def brute(rows):
    """Every window of every text in order, by a dictionary."""
    distinct = sorted({(NULL if i is None else i, hashlib.sha256((t or "").encode()).hexdigest(), t or "") for i, t in rows})
    seen, out = set(), {}
    for i, sha, t in distinct:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - S.LENGTH + 1):
            w = b[p : p + S.LENGTH]
            if w in seen:
                gone[p : p + S.LENGTH] = b"\1" * S.LENGTH
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[(i, sha)] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted((NULL if i is None else i, *out[(NULL if i is None else i, hashlib.sha256((t or "").encode()).hexdigest())]) for i, t in rows)


def _rows(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(15, 60))) for _ in range(6)] + ["is onhe " * 60, "x" * 400]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(1, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, max(0, len(p) // 3))
            parts += [p[a : len(p) - rng.randint(0, len(p) // 3)], word()]
        rows.append((i, " ".join(parts)))
    rows += [(n, None), (n + 1, ""), (None, rows[0][1]), (3, rows[3][1]), (3, rows[4][1] + "!"), (n + 2, rows[5][1]), (n + 2, rows[5][1])]
    rng.shuffle(rows)
    return rows


def _got(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).selectExpr("*", "text AS block", "doc_id AS shard")
    out = S.substring_dedup(df).collect()
    return sorted((NULL if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out)


def test_equals_brute_force(spark):
    rows = _rows(120, 1)
    assert _got(spark, rows) == brute(rows)


def test_cut_texts_and_hot_grams(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 300)
    monkeypatch.setattr(S, "GATHER", 5000)
    rows = _rows(60, 2)
    want = brute(rows)
    raw = [np.frombuffer((t or "").encode(), np.uint8) for _, t in rows]
    grams = np.concatenate([x["gram"] for r in raw for _, _, x, _ in S.text_regions(r, np.array([0, len(r)]))])
    hot = np.unique(S._bucket(grams, 64))[::3]
    ids = np.array([NULL if i is None else i for i, _ in rows])
    shas = np.array([int(hashlib.sha256((t or "").encode()).hexdigest()[:16], 16) for _, t in rows], np.uint64)
    data = "".join(t or "" for _, t in rows).encode()
    offsets = np.cumsum([0] + [len((t or "").encode()) for _, t in rows])
    rest, covered = S.fold(np.concatenate(list(S._entries(ids, shas, np.frombuffer(data, np.uint8), offsets, hot, 64, 5))))
    order = np.argsort(rest["gram"], kind="stable")
    g = rest["gram"][order]
    twin = np.zeros(len(g), bool)
    twin[1:] |= g[1:] == g[:-1]
    twin[:-1] |= g[1:] == g[:-1]
    check = S._report(rest[order[twin]], 1)
    text = {(int(i), int(s)): (t or "").encode() for i, s, (_, t) in zip(ids, shas, rows, strict=True)}
    monkeypatch.setattr(S, "CHUNK", 500)
    monkeypatch.setattr(S, "BATCH", 90)
    more = S.compare(check, [text[(int(e["doc"]), int(e["sha"]))][e["at"] : e["at"] + int(e["n"]) + S.LENGTH - 1] for e in check], np.arange(len(check)) % 7)
    rows_, of = S._slices(np.concatenate([S._report(covered, 0), more]))
    got = []
    for i, s, (_, t) in zip(ids, shas, rows, strict=True):
        a, b = of.get((int(i), int(s)), (0, 0))
        got.append((int(i), *S._result((t or "").encode(), rows_["at"][a:b], rows_["n"][a:b])))
    assert sorted(got) == want


def test_empty_table(spark):
    assert S.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [1, 7, 100])
def test_block_of_equals_spark(spark, n):
    ids = np.array([0, 1, -5, 10**15, NULL])
    shas = [hashlib.sha256(str(i).encode()).hexdigest() for i in ids]
    df = spark.createDataFrame([(int(i), x) for i, x in zip(ids, shas, strict=True)], "doc_id long, sha string")
    got = [r[0] for r in df.selectExpr(S._block_sql(n)).collect()]
    assert got == S._block_of(ids, np.array([int(x[:16], 16) for x in shas], np.uint64), n).tolist()


def test_every_gram_hot_and_all_ids_null(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", -(10**3))
    rows = _rows(40, 3)
    assert _got(spark, rows) == brute(rows)
    rows = [(None, t) for _, t in _rows(20, 4)]
    assert _got(spark, rows) == brute(rows)


def test_index_family_against_a_dictionary():
    """Levels are lexicographic and distinct at any time, and the later of equal windows are covered."""
    rng = np.random.default_rng(2)
    pool = rng.integers(97, 99, (40, S.LENGTH)).astype(np.uint8)
    pool[:, :-3] = pool[0, :-3]  # common prefixes up to the last bytes
    keys = pool[rng.integers(0, 40, 700)]
    ranks = rng.permutation(700)
    family = S.IndexFamily()
    for a in range(0, 700, 23):
        family.add(keys[a : a + 23], ranks[a : a + 23])
        for k, r in family.levels.values():
            rows = [x.tobytes() for x in k]
            assert rows == sorted(set(rows)) and len(r) == len(rows)
    assert len(family.levels) <= 6
    first = {}
    for k, r in sorted(zip([x.tobytes() for x in keys], ranks.tolist(), strict=True), key=lambda x: x[1]):
        first.setdefault(k, r)
    assert sorted(family.finish().tolist()) == sorted(set(ranks.tolist()) - set(first.values()))
