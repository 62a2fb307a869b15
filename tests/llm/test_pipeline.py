"""The pipeline as a chain, against a plain version of its stages."""

import random
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import quality_rules


def _texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    near = base[0].split(" ")
    near[30] = "changed"
    far = base[1].split(" ")
    for k in range(0, 60, 6):
        far[k] = "other"
    key = "ghp_" + "".join(rng.choice("abcdefABCDEF0123456789") for _ in range(36))
    rows = [(10 + i, t) for i, t in enumerate(base)]
    rows += [(3, base[0].replace(" ", "  ")), (40, " ".join(near)), (41, " ".join(far)), (42, " ".join(word() for _ in range(70)) + f' token = "{key}" end'), (43, "too short"), (44, None), (45, ""), (46, "x " * 100)]
    rows += [(47, " ".join(word() for _ in range(3000)))]
    return rows, key


def _shingles(t):
    ws = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def test_run_equals_the_plain_chain(spark, tmp_path):
    rows, key = _texts()
    df = spark.createDataFrame([(d, t, "en", "src") for d, t in rows], "doc_id long, text string, lang string, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    good = {r.doc_id for r in quality_rules.quality_verdicts(df).filter("kept").collect()}
    assert good.isdisjoint({43, 44, 45, 46}) and {10, 3, 40, 41, 42, 47} <= good
    left = {}
    for d, t in sorted((r for r in rows if r[0] in good), key=lambda r: (-len(r[1]), r[0])):
        left.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), (d, t))
    docs = sorted(left.values())
    root = {d: d for d, _ in docs}
    for _ in docs:
        for a, x in docs:
            for b, y in docs:
                s, t = _shingles(x), _shingles(y)
                if 100 * len(s & t) >= 80 * len(s | t):
                    root[a] = root[b] = min(root[a], root[b])
    docs = [(d, t.replace(key, "[SECRET]")) for d, t in docs if root[d] == d]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got, fill = {}, {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == {d: len(lib.encode(t, add_special_tokens=False).ids) + 1 for d, t in docs}
    assert 10 not in got and 40 not in got and {3, 41, 42, 47} <= set(got)  # a copy and a near copy went, the others stayed
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0
