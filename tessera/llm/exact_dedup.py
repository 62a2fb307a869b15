"""Exact dedup (operator 5): skew-safe combining of equal normalised texts.

Three merges, each grouping by the *full* normalised text beside its digest, so a digest collision can never
join two different texts:

1. local: the map-side partial aggregation of Spark's hash aggregate collapses the copies inside one task;
2. salted: (digest, salt, text), where only digests that hold more than a thousandth of the rows get more than
   one salt, so that no task receives a hot group and an ordinary text is shuffled once;
3. global: the salt winners, of which a group has at most SALTS.

The winner of a group is the largest rank = (code points of the original text, then smallest doc_id), kept in one
decimal so that the aggregation buffer is fixed-width and Spark uses hash aggregation throughout.

Edge cases: a null text counts as empty; empty and blank texts form one group; a null doc_id is a row like any
other and loses every tie (a group of only null ids keeps a null keep_id and its rows are all `kept`);
repeated rows with one doc_id are counted separately and each is `kept` if the id is the winner's; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WS, materialise

SALTS = 64
#: A digest is hot if it holds at least this share of all rows; so there are at most 1 / HOT hot digests.
HOT = 0.001


def _power(k: int) -> Column:
    return F.lit(str(1 << k)).cast("decimal(38,0)")


def normalised(text: Column) -> Column:
    """text without space and 0x09-0x0D; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for ch in WS:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def _rank(n: Column, doc_id: Column) -> Column:
    low = F.coalesce(_power(63) - doc_id.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return (n.cast("decimal(12,0)") * _power(65) + low).cast("decimal(38,0)")


def _winner(rank: Column) -> Column:
    low = rank % _power(65)
    return F.when(low > 0, (_power(63) - low).cast("long"))


def exact_dedup(docs: DataFrame, salts: int = SALTS, hot: float = HOT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    norm = normalised(F.col("text"))
    base = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"), norm.alias("norm"))
    # Each row's digests, once; the texts are read once more, to be compared.
    digests = base.select("doc_id", "n", F.sha2("norm", 256).alias("text_sha256"), F.xxhash64("norm").alias("h"))
    digests = materialise(digests, "digests")
    total = digests.count()
    counts = digests.groupBy("h").count().filter(F.col("count") >= max(2 * salts, hot * total))
    # Bounded by 1 / hot rows: no more groups than that can hold such a share each.
    hot_keys = [r[0] for r in counts.collect()]
    spread = F.pmod(F.xxhash64("doc_id", "n"), F.lit(salts)).cast("int")
    salt = F.when(F.col("h").isin(hot_keys), spread).otherwise(F.lit(0)) if hot_keys else F.lit(0)

    # 1 and 2: local, then salted. The digest and the second hash name the group afterwards.
    salted = base.withColumn("h", F.xxhash64("norm")).withColumn("salt", salt).groupBy("h", "salt", "norm").agg(
        F.max(_rank(F.col("n"), F.col("doc_id"))).alias("rank"), F.count(F.lit(1)).alias("size")
    ).withColumn("text_sha256", F.sha2("norm", 256))
    is_hot = F.col("h").isin(hot_keys) if hot_keys else F.lit(False)
    cold = salted.filter(~is_hot).select("text_sha256", "h", "salt", "rank", "size")
    if hot_keys:
        # 3: the salt winners of hot groups only; their number is bounded by salts / hot.
        whole = salted.filter(is_hot).groupBy("text_sha256", "h", "norm").agg(
            F.max("rank").alias("rank"), F.sum("size").alias("size")
        )
        again = whole.select("text_sha256", "h", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "rank", "size")
        cold = cold.unionByName(again)
    winners = cold.select("text_sha256", "h", "salt", _winner(F.col("rank")).alias("keep_id"), F.col("size").alias("group_size"))
    members = digests.select("doc_id", "text_sha256", "h", salt.alias("salt"))
    return members.join(winners, ["text_sha256", "h", "salt"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """docs without the copies: the rows that exact_dedup keeps, all columns as they were, whatever their names.

    A null doc_id never names a winner uniquely, so of a group of null ids every row stays. Of rows that repeat
    both doc_id and normalised text the longest stays, and of equally long ones that of the largest text.
    """
    kept = exact_dedup(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows"))
    kept = materialise(kept, "kept")
    d, k = docs.alias("d"), kept.alias("k")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.sha2(normalised(F.col("d.text")), 256) == F.col("k.text_sha256"))
    if not kept.filter("rows > 1 AND doc_id IS NOT NULL").take(1):
        return d.join(k, same, "left_semi")
    once = d.join(k.filter("k.rows = 1 OR k.doc_id IS NULL"), same, "left_semi")
    more = d.join(k.filter("k.rows > 1 AND k.doc_id IS NOT NULL"), same, "left_semi")
    # The row as one value, beside which no name can clash.
    more = more.select(F.struct(*[F.col(f"d.`{c}`") for c in docs.columns]).alias("row"), F.col("d.doc_id").alias("id"), F.coalesce("d.text", F.lit("")).alias("t"))
    best = F.max_by("row", F.struct(F.length("t"), "t")).alias("row")
    more = more.groupBy("id", F.sha2(normalised(F.col("t")), 256).alias("key")).agg(best)
    return once.unionByName(more.select("row.*"))
