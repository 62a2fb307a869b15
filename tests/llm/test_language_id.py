import math
from collections import defaultdict

import numpy as np

from tessera.llm import language_id as L

TEXTS = {"a": [b"the cat sat on the mat", b"a cat and a hat"], "b": [b"der hund und die katze", b"das ist ein hund \xc3\xbc"], "c": [b"zzz"]}


def brute(text, docs):
    """Code length by walking dictionaries."""
    count = defaultdict(lambda: defaultdict(int))
    for d in docs:
        d = b"\n" * L.ORDER + d
        for i in range(len(d)):
            for k in range(min(L.ORDER, i) + 1):
                count[d[i - k : i]][d[i]] += 1
    data, bits = b"\n" * L.ORDER + text, 0.0
    for i in range(L.ORDER, len(data)):
        for k in range(L.ORDER, -1, -1):
            seen = count.get(data[i - k : i])
            if not seen:
                continue
            n, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits += math.log2((n + d) / seen[data[i]])
                break
            bits += math.log2((n + d) / d)
        else:
            bits += 8
    return bits


def test_code_lengths_equal_a_walk_over_dictionaries():
    trees = L.fit(TEXTS)
    texts = [b"the cat", b"der hut", b"", b"\xff\x00q", b"zz the zz", b"mat\n\nmat", "ünd".encode()]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    got = L.code_lengths(raw, np.cumsum([0] + [len(t) for t in texts]), trees)
    for i, t in enumerate(texts):
        for j, lang in enumerate(trees.langs):
            assert abs(got[i, j] - brute(t, TEXTS[lang])) < 1e-3, (t, lang)


def test_long_text_is_a_sum_over_pieces(monkeypatch):
    trees = L.fit(TEXTS)
    raw = np.frombuffer(b"the cat and der hund " * 50, np.uint8)
    whole = L.code_lengths(raw, np.array([0, len(raw)]), trees)
    monkeypatch.setattr(L, "BLOCK", 37)
    assert np.allclose(whole, L.code_lengths(raw, np.array([0, len(raw)]), trees), rtol=1e-5)


def test_edge_rows(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(20)] + [(i, "der hund und die katze", "de") for i in range(20, 40)]
    rows += [(50, None, "en"), (51, "", "en"), (52, "12 34", None), (53, "the mat", None), (None, "die katze", "de")]
    out = {r.doc_id: r for r in L.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [out[k].lang_pred for k in (50, 51, 52, 53, None)] == ["und", "und", "und", "en", "de"]
    assert all(0 <= r.score <= 1 for r in out.values())
    empty = L.language_id(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert empty.count() == 0
