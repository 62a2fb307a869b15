"""Toxicity and quality: held-out accuracy, gradients, blocks and edge cases."""

import zlib

import numpy as np
import pytest

from tessera.llm import quality_mil as Q
from tessera.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def _flat(texts):
    return np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0] + [len(t.encode()) for t in texts])


def _labelled(label, mod, out):
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text, {label} FROM '{SF}/documents.parquet' JOIN '{SF}/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % mod == out]
    return [r for r in rows if zlib.crc32(str(r[0]).encode()) % mod != out], held


def test_toxicity_on_held_out_rows():
    train, held = _labelled("toxic", 3, 1)
    pos, neg = [r for r in train if r[2]], [r for r in train if not r[2]]
    use = pos[:300] + neg[:300]
    model = T.fit([r[1] for r in use], np.array([r[2] for r in use]))
    held = held[:600]
    s, y = T.scores(*_flat([r[1] for r in held]), model), np.array([r[2] for r in held])
    assert (s[y == 0] >= T.THRESHOLD).mean() < 0.03 and (s[y == 1] >= T.THRESHOLD).mean() > 0.7
    # Cut into blocks, texts keep their scores.
    raw, offsets = _flat([r[1] for r in held[:20]])
    whole = T.counts(raw, offsets, model)
    for block in (97, 1000):
        T.BLOCK, kept = block, T.BLOCK
        try:
            assert np.array_equal(T.counts(raw, offsets, model)[:, 1:], whole[:, 1:])
        finally:
            T.BLOCK = kept


def test_gapped_and_inserted_characters_share_features():
    def product(a, b):
        x, y = np.zeros(1 << T.BITS), np.zeros(1 << T.BITS)
        for v, s in ((x, a), (y, b)):
            f, w = T.features(s.encode())
            np.add.at(v, f, w)
        return x @ y / np.sqrt((x @ x) * (y @ y))

    assert min(product("idiot", s) for s in ("i d i o t", "id*iot", "1DIOT", "idi-ot")) > 4 * product("idiot", "nation")


def test_longer_gaps_and_signs_beyond_ascii():
    def vector(s):
        v = np.zeros(1 << T.BITS)
        f, w = T.features(s.encode())
        np.add.at(v, f, w)
        return v / np.sqrt(v @ v)

    far = 4 * vector("idiot") @ vector("nation")
    for s in ("i--d--i--o--t", "i - d - i - o - t", "i·d·i·o·t", "i…d…i…o…t", "i\u200bd\u200bi\u200bo\u200bt", "id--iot", "id … iot", "i  diot"):
        assert vector(" idiot ") @ vector(f" {s} ") > far, s
    # Texts that stand side by side are not read as one word, and code points keep their texts.
    texts = ["i", "d", "i", "ö·", "·o", "", "x y z", "–é"]
    symbols, offsets = T.decoded(*_flat(texts))
    assert np.diff(offsets).tolist() == [1, 1, 1, 2, 2, 0, 3, 2] and symbols[:3].tolist() == [9, 4, 9]


def test_spelled_out_and_short_insults_are_found():
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list("abcdefghijklmnoprstuvwz"), 6)) for _ in range(150)]
    clean = [" ".join(rng.choice(made, 40)) + "." for _ in range(240)]
    insults = ["idiot", "moron", "oaf", "scum"]
    toxic = [t.replace(" ", f" {insults[i % 4]} ", 2) for i, t in enumerate(clean[:120])]
    labels = np.array([1] * 120 + [0] * 120)
    assert "oaf" in T.landmarks(toxic + clean[120:], labels, rng)
    model = T.fit(toxic + clean[120:], labels)
    for sep in ("--", " - ", "·", "…"):
        new = [t.replace(" ", f" {sep.join(insults[i % 2])} ", 2) for i, t in enumerate(clean[120:160])]
        assert (T.scores(*_flat(new), model) >= T.THRESHOLD).mean() > 0.9, sep
    assert (T.scores(*_flat(clean[120:]), model) >= T.THRESHOLD).mean() < 0.05
    # Cut into pieces, they keep their counts.
    raw, offsets = _flat([" é i--d--i--o--t, id  …  iot ·· mo—ron. a - b - c " * 30, "i - d", "x" * 500])
    whole = T.counts(raw, offsets, model)
    for block in (1, 7, 97):
        T.BLOCK, kept = block, T.BLOCK
        try:
            assert np.array_equal(T.counts(raw, offsets, model), whole)
        finally:
            T.BLOCK = kept


def test_no_sentence_with_an_insult_is_left_out(monkeypatch):
    train, _ = _labelled("toxic", 3, 1)
    pos, neg = [r for r in train if r[2]][: T.SAMPLE], [r for r in train if r[2] == 0][: T.SAMPLE]
    texts, labels = [r[1] for r in pos + neg], np.array([r[2] for r in pos + neg])
    # What the first machine reads and what the last one keeps.
    monkeypatch.setattr(T, "LANDMARKS", 96)
    read, machine, kernel, plain = [], [], T.svm, T.features

    def svm(z, y, c):
        machine.append((len(z), (y > 0).sum()))
        return kernel(z, y, c)

    def features(raw):
        read.append(raw.decode())
        return plain(raw)

    monkeypatch.setattr(T, "svm", svm)
    monkeypatch.setattr(T, "features", features)
    T.fit(texts, labels)
    read = set(read)
    holds = [[s for s in T._SENTENCE.findall(t) if len(s) > 3 and "idiot" in s.lower()] for t in texts[: len(pos)]]
    assert sum(map(len, holds)) > 50 and all(s in read for hold in holds for s in hold)
    whole = [sum(len(s) > 3 for s in T._SENTENCE.findall(t)) for t in texts[: len(pos)]]
    assert machine[0][1] == sum(whole) and machine[1][1] == machine[2][1] == sum(min(T.TOP, n) for n in whole)


def test_attention_gradient_is_right():
    rng = np.random.default_rng(0)
    x, of, y, wt = rng.standard_normal((9, 5)), np.array([0, 0, 1, 1, 1, 2, 3, 3, 3]), np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 1])
    p = {"W": rng.standard_normal((5, 4)), "b": rng.standard_normal(4), "V": rng.standard_normal((4, 3)), "U": rng.standard_normal((4, 3)), "w": rng.standard_normal(3), "c": rng.standard_normal(4), "d": np.array(0.1)}

    def loss():
        s, _ = Q.forward(x, of, p)
        return -(wt * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum() / wt.sum()

    s, held = Q.forward(x, of, p)
    for name, g in Q.gradient(x, y, wt, s, held, p).items():
        for i in np.ndindex(p[name].shape):
            p[name][i] += 1e-6
            up = loss()
            p[name][i] -= 2e-6
            down = loss()
            p[name][i] += 1e-6
            assert g[i] == pytest.approx((up - down) / 2e-6, abs=1e-5), (name, i)


def test_quality_on_held_out_rows():
    train, held = _labelled("quality", 5, 0)
    bad, good = [r for r in train if not r[2]], [r for r in train if r[2]]
    use = bad[:300] + good[:300]
    model = Q.fit([r[1] for r in use], np.array([r[2] for r in use]))
    s, y = Q.scores(*_flat([r[1] for r in held]), model), np.array([r[2] for r in held])
    assert (s[y == 1] >= Q.THRESHOLD).mean() > 0.97 and (s[y == 0] >= Q.THRESHOLD).mean() < 0.1
    x, of = Q.passages(*_flat(["", " ", "a b", "w " * 200]))
    assert of.tolist() == [0, 1, 2, 3, 3, 3, 3] and not np.isnan(x).any()


def test_edge_rows(spark):
    good = [(i, "the cat sat on the mat and so on, as cats do. " * 3) for i in range(40)]
    bad = [(i, "IDIOT moron!! ### scum *** trash %%% " * 3) for i in range(40, 80)]
    rows = good + bad + [(90, None), (91, ""), (92, " \n"), (None, "x"), (90, "again"), (93, "w" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS score", "text AS lang")
    labels = spark.createDataFrame([(i, int(i < 40), int(i >= 40)) for i in range(80)] + [(91, None, None)], "doc_id long, quality int, toxic int")
    for out in (T.toxicity(docs, labels).collect(), Q.quality(docs, labels).collect()):
        assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    none = labels.limit(0)
    assert {r.predicted for r in T.toxicity(docs, none).collect()} == {0}
    assert {r.score for r in Q.quality(docs, none).collect()} == {0.5}
    assert T.toxicity(docs.limit(0), labels).count() == Q.quality(docs.limit(0), labels).count() == 0


def test_a_long_text_has_the_passages_of_one_piece(monkeypatch):
    rng = np.random.default_rng(6)
    words = ["idea", "Ένα", "x" * 90, "a", "Big!", "7"]
    for text in (" ".join(rng.choice(words, 5000)) + "\n ", "  \n" + "y" * 3000 + " end", "z" * 700, " " * 900, "\t".join(rng.choice(words, 64 * 9))):
        raw = np.frombuffer(("before it. " + text + "after").encode(), np.uint8)
        offsets = np.array([0, 11, 11 + len(text.encode()), len(raw)])
        monkeypatch.setattr(Q, "BLOCK", 1 << 19)
        x, of = Q.passages(raw, offsets)
        for block in (97, 500, 1000):
            monkeypatch.setattr(Q, "BLOCK", block)
            y, to = Q.passages(raw, offsets)
            assert np.array_equal(of, to) and np.allclose(x, y, atol=1e-6), (block, text[:20])
