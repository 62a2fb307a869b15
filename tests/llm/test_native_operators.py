"""Exact dedup and quality rules: edge cases, and the oracles on the smallest tables."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, quality_rules
from tessera.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROWS = [(5, "a b"), (3, "ab"), (4, "a\n b"), (9, "a \t b"), (7, None), (8, ""), (6, "  "), (1, "x"), (1, "x"), (2, "x y"), (None, "x y"), (None, "lonely"), (10, " x")]


@pytest.mark.parametrize("hot", [0.001, 0.0])
def test_exact_dedup_groups(spark, hot, monkeypatch):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("keep_id", F.lit(1)).withColumn("norm", F.lit("q"))
    out = exact_dedup.exact_dedup(df, salts=1 if hot == 0.0 else 64, hot=hot).collect()
    by = {}
    for d, t in ROWS:
        by.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((d, t or ""))
    want = []
    for norm, docs in by.items():
        keep = min(docs, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))[0]
        want += [(d, keep, len(docs), d == keep, hashlib.sha256(norm.encode()).hexdigest()) for d, _ in docs]
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(map(str, want))


def test_hot_groups_are_salted(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = exact_dedup.exact_dedup(df, salts=8)
    hot = out.filter("group_size > 1").agg(F.count("*").alias("n"), F.min("keep_id").alias("a"), F.max("keep_id").alias("b"), F.max("group_size").alias("s"), F.count_if("kept").alias("k")).first()
    assert tuple(hot) == (1000, 0, 0, 1000, 1) and out.count() == 3000


def test_keep_first_keeps_columns_and_one_row(spark):
    df = spark.createDataFrame([(d, t, "s") for d, t in ROWS], "doc_id long, text string, source string")
    out = exact_dedup.keep_first(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted([("9", "a \t b"), ("6", "  "), ("1", "x"), ("2", "x y"), ("None", "lonely"), ("10", " x")])
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def _repeat_words(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    hit = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    return len(hit)


def test_measures(spark):
    base = " ".join(f"w{i}" for i in range(30))
    texts = [None, "", " \n\t", "one", base, base + "\n" + base, "a " * 7, "a " * 8, "a " * 9, "a " * 40, base + " # | x *$ <b>", "l 1\nl 1\n \nl 1\nl 2", "q r s t u v w x y q r s t u v w x y q r s t u v w x z", "é ü ñ\x0bz", "word " * 20000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    out = {r.doc_id: r for r in quality_rules.quality_verdicts(df).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = out[i]
        assert (r.n_words, r.word_chars) == (len(ws), sum(map(len, ws))), i
        assert r.n_symbols == sum(t.count(c) for c in "#*$%&|<>") and r.n_dup_lines == len(ls) - len(set(ls))
        assert r.n_repeat_words == _repeat_words(t), (i, r.n_repeat_words)
        assert r.base_failed == (len(ws) < 20 or 100 * r.n_repeat_words > 30 * len(ws)) and not (r.base_failed and r.kept)


def test_order_does_not_change_the_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = quality_rules.Measures(F.col("text"))
    a = docs.select("doc_id", quality_rules.cascade(quality_rules.RULES, m).alias("k"))
    b = docs.select("doc_id", quality_rules.cascade(quality_rules.RULES[::-1], m).alias("k"))
    assert a.exceptAll(b).count() == 0
    plan = quality_rules.plan_cascade(docs)
    assert sorted(r.name for r in plan) == sorted(r.name for r in quality_rules.RULES)
    assert quality_rules.plan_cascade(docs.limit(0)) == quality_rules.RULES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = duckdb.sql(ORACLES[name])
    assert sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(str, rel.select(*cols).fetchall()))


def test_keep_first_of_repeated_ids_takes_the_longest_row(spark):
    rows = [(1, "a b", "x"), (1, "a  b", "y"), (1, "ab", "z"), (2, "c", "k"), (2, "c", "k"), (2, "d", "k"), (None, "e", "k"), (None, " e", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `__key` string").withColumn("rows", F.lit(1)).withColumn("id", F.lit(2))
    out = exact_dedup.keep_first(df)
    assert out.columns == df.columns
    got = sorted((str(r.doc_id), r.text, r["__key"]) for r in out.collect())
    assert got == [("1", "a  b", "y"), ("2", "c", "k"), ("2", "d", "k"), ("None", " e", "k"), ("None", "e", "k")]


def test_a_long_run_is_scanned_in_linear_time(spark):
    from tessera.llm import secret_scan

    text = "acgt" * 250_000
    df = spark.createDataFrame([(1, text), (2, "token=" + "k3Y" * 9 + " " + text + "==" + "q7W" * 8)], "doc_id long, text string")
    forest = secret_scan.train(spark)
    assert sorted((r.doc_id, r.length) for r in secret_scan.scan(df, forest).collect())[0] == (2, 24)
