import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import secret_scan as S

HEX = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"


@pytest.fixture(scope="module")
def forest(spark):
    return S.train(spark)


def _walk(node, f):
    while node.feature >= 0:
        node = node.low if f[node.feature] <= node.cut else node.high
    return node.share


def test_forest_column_equals_a_walk_and_separates_new_findings(spark, forest):
    new = S.labelled_findings(120, seed=99)
    df = spark.createDataFrame(new, "before string, core string, after string, label double")
    f = S.features(F.col("core"), F.col("before"), F.col("after"))
    rows = df.select(f.alias("f"), S.forest_column(forest, f).alias("s"), "label").collect()
    assert all(abs(r.s - sum(_walk(t, r.f) for t in forest) / len(forest)) < 1e-9 for r in rows)
    assert sum((r.s >= 0.5) == (r.label == 1) for r in rows) >= 0.95 * len(rows)


def test_findings_and_redaction(spark, forest):
    rows = [
        (1, f'é words before token = "{HEX}" and after'),
        (2, f"twice api_key={HEX} and\n\n api_key={HEX}, done"),
        (3, "plain words only, nothing to see in thisverylongwordwithoutdigits"),
        (4, f"commit {HEX} fixes it"),
        (5, None),
        (6, ""),
        (7, "card 4040549990366437 and mail er.48@mail9.example.com +1 (678) 555-5272"),
        (None, f"TOKEN = \"{HEX.upper()}\"!! and"),
        (8, "words " * 5000 + f"token = \"{HEX}\""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("core", F.lit("x")).withColumn("start", F.lit(1))
    found = S.scan(df, forest).collect()
    by = {}
    for r in found:
        text = dict(rows)[r.doc_id]
        assert re.fullmatch(S.KEY + "+", text[r.start : r.start + r.length])
        if r.is_secret:
            by.setdefault(r.doc_id, []).append(text[r.start : r.start + r.length])
    assert by == {1: [HEX], 2: [HEX, HEX], None: [HEX.upper()], 8: [HEX]}
    clean = {r.doc_id: r for r in S.redact(df, forest).collect()}
    assert clean[2].text == "twice api_key=[SECRET] and\n\n api_key=[SECRET], done" and clean[2].core == "x"
    assert clean[5].text is None and clean[6].text == "" and all(clean[k].text == dict(rows)[k] for k in (3, 4, 7))
    assert S.scan(df.limit(0), forest).count() == 0


def test_every_place_in_a_run_without_blanks(spark, forest):
    texts = [
        f"é x api_key={HEX}&api_key={HEX},{HEX} end",
        f"see sha1={HEX};token={HEX} now",
        f'x{HEX}9,token="{HEX}" after',
        f'{{"sha1":"{HEX}","token":"{HEX}"}}',
        f"api_key={HEX}==\u00a0" * 50,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = S.scan(df, forest).collect()
    for i, text in enumerate(texts):
        own = sorted((r.start, r.length) for r in rows if r.doc_id == i)
        assert own == [(m.start(), m.end() - m.start()) for m in re.finditer(S.CANDIDATE, text)]
    secret = {(r.doc_id, r.start) for r in rows if r.is_secret}
    assert {(i, texts[i].rindex(HEX)) for i in (1, 2, 3)} <= secret and not {(1, texts[1].index(HEX)), (2, 0), (3, texts[3].index(HEX))} & secret
    assert len({s for d, s in secret if d == 4}) == 50
    clean = {r.doc_id: r.text for r in S.redact(df, forest).collect()}
    assert clean[1] == "see sha1=[SECRET];token=[SECRET] now" and HEX not in clean[0] + clean[4]


def test_no_python_in_the_plan(spark, forest):
    plan = S.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"), forest)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
