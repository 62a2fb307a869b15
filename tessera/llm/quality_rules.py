"""Quality rules (operator 6): a short-circuit cascade of native column rules.

`measures` gives the counted columns, `RULES` are predicates over a text that reject it, `plan_cascade` times every
rule and counts its rejections on a bounded sample and orders the rules by rejections per second, and `cascade`
evaluates them as one CASE expression: Spark stops at the first rule that rejects a row. The verdict is the
conjunction of all rules and so does not depend on the order; only the cost does.

Only built-in functions are used: no Python, pandas, Arrow or RDD code.

Edge cases: a null text has no words and fails the base rule, as do empty and blank texts; repeated rows are judged
one by one; extra columns are ignored; an empty table gives an empty result and a plan in declared order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WS

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows on which costs and selectivities are estimated.
SAMPLE = 400


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, and only if the whole expression is."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The maximal runs of characters other than space and 0x09-0x0D."""
    t = F.btrim(_text(text), F.lit(WS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "[\\x20\\x09-\\x0D]+"))


def n_chars_in(text: Column, chars: str) -> Column:
    """How many characters of text are one of chars."""
    rest = _text(text)
    for ch in chars:
        rest = F.replace(rest, F.lit(ch), F.lit(""))
    return (F.length(_text(text)) - F.length(rest)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(_text(text), "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")
    return let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def n_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(F.filter(F.split(_text(text), "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")).cast("long")


def n_repeat_words(ws: Column, w: int = WINDOW) -> Column:
    """Words inside w-word windows that stand in the text twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash; a text without two equal hashes, which is nearly every text, ends there.
    For the others the (hash, position) pairs are sorted, neighbours with equal words marked, and the union of the
    marked windows measured: n log n for n words, whatever repeats.
    """

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        marked = let(
            pairs,
            lambda p: F.filter(
                F.transform(
                    p,
                    lambda x, k: F.when(
                        (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"]), x["i"]
                    ),
                ),
                lambda x: x.isNotNull(),
            ),
        )
        return let(
            F.array_sort(marked),
            lambda m: F.aggregate(
                F.transform(m, lambda x, k: F.least(F.lit(w), F.coalesce(F.get(m, k + 1) - x, F.lit(w)))),
                F.lit(0).cast("long"),
                lambda a, b: a + b,
            ),
        )

    def hashes(ws: Column) -> Column:
        """Of each w-word window: the hashes of spans double in length until they reach w, a power of two."""

        def joined(h: Column, span: int) -> Column:
            return let(h, lambda a: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + span))))

        h, span = F.transform(ws, lambda x, i: F.xxhash64(x, F.get(ws, i + 1))), 2
        while span < w:
            h, span = joined(h, span), 2 * span
        return F.slice(h, F.lit(1), F.size(ws) - (w - 1))

    def found(ws: Column) -> Column:
        return let(
            hashes(ws),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)),
        )

    return F.when(F.size(ws) <= w, F.lit(0).cast("long")).otherwise(found(ws))


class Measures:
    """Columns that rules may ask for: each an expression over the text, or a column that is there already."""

    def __init__(self, text: Column, have: dict[str, Column] | None = None):
        self.text, self.have = text, have or {}

    def _get(self, name: str, make: Callable[[], Column]) -> Column:
        return self.have[name] if name in self.have else make()

    @property
    def n_words(self) -> Column:
        return self._get("n_words", lambda: F.size(words(self.text)).cast("long"))

    @property
    def word_chars(self) -> Column:
        return self._get("word_chars", lambda: F.length(F.array_join(words(self.text), "")).cast("long"))

    @property
    def n_symbols(self) -> Column:
        return self._get("n_symbols", lambda: n_chars_in(self.text, SYMBOLS))

    @property
    def n_dup_lines(self) -> Column:
        return self._get("n_dup_lines", lambda: n_dup_lines(self.text))

    @property
    def n_repeat_words(self) -> Column:
        return self._get("n_repeat_words", lambda: let(words(self.text), n_repeat_words))

    @property
    def n_exclamations(self) -> Column:
        return n_chars_in(self.text, "!")

    @property
    def n_lines(self) -> Column:
        return n_lines(self.text)

    @property
    def n_stutters(self) -> Column:
        """Words equal to the word before."""
        return self._get("n_stutters", lambda: let(words(self.text), n_stutters))


def n_stutters(ws: Column) -> Column:
    return F.size(F.filter(ws, lambda x, i: x == F.get(ws, i - 1))).cast("long")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_stutters appended."""
    t = F.col(text)
    every = let(
        words(t),
        lambda a: F.struct(
            F.size(a).cast("long").alias("n_words"),
            F.length(F.array_join(a, "")).cast("long").alias("word_chars"),
            n_repeat_words(a).alias("n_repeat_words"),
            n_stutters(a).alias("n_stutters"),
        ),
    )
    return docs.withColumn("__m", every).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col("__m.n_words"),
        F.col("__m.word_chars"),
        n_chars_in(t, SYMBOLS).alias("n_symbols"),
        n_dup_lines(t).alias("n_dup_lines"),
        F.col("__m.n_repeat_words"),
        F.col("__m.n_stutters"),
    )


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat > 30 * n_words)


@dataclass(frozen=True)
class Rule:
    """rejects(measures) is true for a text to be dropped; it is never null."""

    name: str
    rejects: Callable[[Measures], Column]


#: Thresholds of the rules, each stated in integers so that any SQL engine agrees.
RULES = [
    Rule("too_few_words", lambda m: m.n_words < 20),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("exclamations", lambda m: 10 * m.n_exclamations > 3 * m.n_words),
    Rule("dup_lines", lambda m: (m.n_dup_lines >= 3) & (10 * m.n_dup_lines > 3 * m.n_lines)),
    Rule("word_length", lambda m: (m.word_chars > 15 * m.n_words) | (m.word_chars < 2 * m.n_words)),
    Rule("stutters", lambda m: 10 * m.n_stutters > 3 * m.n_words),
    Rule("repeats", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
]


def plan_cascade(docs: DataFrame, rules: list[Rule] = RULES, most: int = SAMPLE, text: str = "text") -> list[Rule]:
    """The rules by falling rejections per second, as measured on a sample of about `most` rows.

    The sample is thinned by the table's count, so its size does not grow with the table. Each rule is run alone over
    the cached sample; its time has the time of an empty scan taken off.
    """
    n = docs.select(F.lit(1)).count()
    if not n:
        return list(rules)
    rate = min(1.0, most / n)
    sample = docs.select(F.col(text).alias("__t"))
    if rate < 1:
        sample = sample.sample(False, rate, 17)
    sample = sample.repartition(4).persist()
    try:
        size = max(1, sample.count())

        def timed(column: Column) -> tuple[float, int]:
            began = time.perf_counter()
            hits = sample.agg(F.count_if(column)).first()[0]
            return time.perf_counter() - began, hits

        empty, _ = timed(F.col("__t").isNull())
        scored = []
        for k, rule in enumerate(rules):
            took, hits = timed(rule.rejects(Measures(F.col("__t"))))
            scored.append((-(hits / size) / max(1e-4, took - empty), k, rule))
        return [rule for _, _, rule in sorted(scored, key=lambda x: x[:2])]
    finally:
        sample.unpersist()


def cascade(rules: list[Rule], of: Measures) -> Column:
    """True if no rule rejects; rules after the first that does are not evaluated."""
    out = None
    for rule in rules:
        hit = rule.rejects(of)
        out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def filter_quality(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their columns as they were."""
    return docs.filter(cascade(plan_cascade(docs, rules, text=text), Measures(F.col(text))))


def quality_verdicts(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id, the counted columns, base_failed and kept for every row.

    The cascade is asked only where the base rule passed, and uses the counts that are there already.
    """
    order = plan_cascade(docs, rules)
    m = measures(docs.select("doc_id", "text"))
    have = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stutters")}
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return m.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(cascade(order, Measures(F.col("text"), have))).alias("kept"),
    )
