"""Secret scans (operator 8): candidates by one pattern, false positives removed by a random forest.

A candidate is a run of at least 16 key characters that holds a digit or a change from small to capital letter. Its
features are its length, its character transitions, how much of it a dictionary covers, whether it stands in a path, an
address or a URL, and the words beside it. A random forest, grown from labelled findings, says how likely it is a secret.

The forest is grown on the driver from a table of labelled findings of bounded size (by default one that is generated
here from rules) whose features are computed by the same column expressions, and is then written out as CASE expressions.
Scanning is one projection: no join, no shuffle, and only built-in functions; texts without a candidate stop at the
pattern.

Edge cases: null and empty texts have no findings; a secret that stands twice is found twice, even without
blanks between, and each place is judged by its own context; repeated rows are scanned one by one; extra columns are ignored by the scan and kept by the redaction; an empty table gives no rows.
"""

from __future__ import annotations

import random
import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.quality_rules import let

KEY = "[A-Za-z0-9+/_-]"
#: Tried at the start of a run only, so that a run of any length is read a fixed number of times.
CANDIDATE = f"(?<!{KEY})(?=[A-Za-z+/_-]*(?:[0-9]|[a-z][A-Z])){KEY}{{16,}}={{0,2}}"
MASK = "[SECRET]"
#: Characters of a run that are kept before its second and later candidates: more than any feature looks back.
CONTEXT = 100
TREES, DEPTH, THRESHOLD = 15, 6, 0.5
#: Labelled findings that are generated if none are given.
FINDINGS = 480

# Words of the dictionary, of contexts that speak for a secret, and of contexts that speak against one.
DICTIONARY = "the and for with this that from name data file test user value index page http www com example image model train node main class home src lib bin path tmp log conf version build release document text item list table time date code order number part line".split()
FOR = "token secret passw pwd api_key apikey api-key auth credential bearer private access_key access-key signing client_key".split()
AGAINST = "sha1 sha256 md5 commit checksum digest hash uuid guid revision etag fingerprint integrity isbn order invoice card iban phone example placeholder".split()

FEATURES = ["length", "digits", "capitals", "hex", "transitions", "distinct", "covered", "slashes", "url", "said_for", "said_against", "assigned", "quoted", "dashes"]


def _count(x: Column, pattern: str) -> Column:
    return F.regexp_count(x, F.lit(pattern)).cast("double")


def features(core: Column, before: Column, after: Column) -> Column:
    """The features of one candidate as an array of doubles, in the order of FEATURES."""
    n = F.length(core).cast("double")
    left = F.lower(before)
    near = F.substring(left, -60, 60)
    return F.array(
        F.least(n, F.lit(200.0)),
        _count(core, "[0-9]") / n,
        _count(core, "[A-Z]") / n,
        F.when(core.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 1.0).otherwise(0.0),
        _count(core, "(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]") / n,
        F.size(F.array_distinct(F.split(core, ""))) / n,
        (n - F.length(F.regexp_replace(F.lower(core), "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))) / n,
        _count(F.concat(F.substring(before, -20, 20), core), "[/\\\\]"),
        F.when(F.substring(left, -80, 80).rlike(r"(://|@|www\.)\S*$"), 1.0).otherwise(0.0),
        F.when(near.rlike("|".join(FOR)), 1.0).otherwise(0.0),
        F.when(near.rlike("|".join(AGAINST)), 1.0).otherwise(0.0),
        F.when(before.rlike(r"[=:]\s*[\"'`]?$"), 1.0).otherwise(0.0),
        F.when(before.rlike("[\"'`]$") & after.rlike("^[\"'`]"), 1.0).otherwise(0.0),
        _count(core, "-"),
    )


def candidates(text: Column) -> Column:
    """Array of (start, core, before, after): the place in code points, the run, and three words on either side."""

    def in_run(cores: Column, gaps: Column, pos: Column, left: Column, right: Column) -> Column:
        # Cores and the gaps around them alternate, so that each hit follows from the ends of the one before it.
        none = F.array().cast("array<struct<start:bigint,core:string,before:string,after:string>>")
        start = F.struct(pos.alias("pos"), left.alias("left"), none.alias("found"))

        def step(acc: Column, k: Column) -> Column:
            core, gap = F.get(cores, k), F.get(gaps, k)
            at, before = acc["pos"] + F.length(gap), F.concat(acc["left"], gap)
            after = F.concat(F.get(gaps, k + 1), F.coalesce(F.get(cores, k + 1), right))
            hit = F.struct(at.alias("start"), core.alias("core"), before.alias("before"), after.alias("after"))
            return F.struct(
                (at + F.length(core)).alias("pos"),
                F.substring(F.concat(before, core), -CONTEXT, CONTEXT).alias("left"),
                F.array_append(acc["found"], hit).alias("found"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(cores) - 1), start, step)["found"]

    def at_word(pieces: Column, hit: Column) -> Column:
        word = lambda k: F.coalesce(F.get(pieces, hit["at"] + k), F.lit(""))
        left = F.concat(word(-3), word(-2), word(-1))
        right = F.concat(word(1), word(2), word(3))
        cores = F.regexp_extract_all(word(0), F.lit(CANDIDATE), F.lit(0))
        return let(cores, lambda c: let(F.split(word(0), CANDIDATE, -1), lambda g: in_run(c, g, hit["pos"], left, right)))

    def hits(pieces: Column) -> Column:
        none = F.array().cast("array<struct<pos:bigint,at:int>>")
        start = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).alias("at"), none.alias("hits"))
        step = lambda acc, x: F.struct(
            (acc["pos"] + F.length(x)).alias("pos"),
            (acc["at"] + 1).alias("at"),
            F.when(x.rlike(CANDIDATE), F.array_append(acc["hits"], F.struct(acc["pos"].alias("pos"), acc["at"].alias("at")))).otherwise(acc["hits"]).alias("hits"),
        )
        return F.aggregate(pieces, start, step)["hits"]

    pieces = F.regexp_extract_all(text, F.lit(r"\s*\S+"), F.lit(0))
    found = let(pieces, lambda p: let(hits(p), lambda h: F.flatten(F.transform(h, lambda x: at_word(p, x)))))
    return F.when(text.rlike(CANDIDATE), found)


# --- the forest -------------------------------------------------------------------------------------------------


@dataclass
class Node:
    """A split (feature <= cut goes to `low`), or a leaf with its share of secrets."""

    share: float
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def _grow(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator) -> Node:
    node = Node(float(y.mean()))
    if depth == 0 or len(y) < 6 or node.share in (0.0, 1.0):
        return node
    best = (1e-9, -1, 0.0)
    base = node.share * (1 - node.share)
    for f in rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1])) + 1), replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        n1 = cut + 1.0
        n2, p1 = len(y) - n1, t[cut] / n1
        p2 = (t[-1] - t[cut]) / n2
        gain = base - (n1 * p1 * (1 - p1) + n2 * p2 * (1 - p2)) / len(y)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), int(f), float((v[cut[k]] + v[cut[k] + 1]) / 2))
    if best[1] < 0:
        return node
    low = x[:, best[1]] <= best[2]
    node.feature, node.cut = best[1], best[2]
    node.low, node.high = _grow(x[low], y[low], depth - 1, rng), _grow(x[~low], y[~low], depth - 1, rng)
    return node


def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> list[Node]:
    """Trees on bootstrap samples, each split over a random part of the features."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        pick = rng.integers(0, len(y), len(y))
        out.append(_grow(x[pick], y[pick], depth, rng))
    return out


def forest_column(forest: list[Node], f: Column) -> Column:
    """The mean share of secrets in the leaves that features f fall in, as CASE expressions."""

    def tree(node: Node) -> Column:
        if node.feature < 0:
            return F.lit(node.share)
        return F.when(F.get(f, F.lit(node.feature)) <= F.lit(node.cut), tree(node.low)).otherwise(tree(node.high))

    total = tree(forest[0])
    for node in forest[1:]:
        total = total + tree(node)
    return total / F.lit(float(len(forest)))


def labelled_findings(n: int = FINDINGS, seed: int = 4) -> list[tuple[str, str, str, float]]:
    """(before, core, after, label): keys in assignments and headers, against hashes, ids, paths, numbers and words."""
    rng = random.Random(seed)
    pick = lambda chars, a, b: "".join(rng.choice(chars) for _ in range(rng.randint(a, b)))
    syllables = "an ba chen de er for ge ing ka le men ny or per qui re sta tion un ver".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    alnum, hexes = string.ascii_letters + string.digits, "0123456789abcdef"
    out = []
    for i in range(n):
        talk, more = f"{word()} {word()} {word()} ", f" {word()} {word()}"
        if i % 2:
            key = rng.choice([pick(hexes, 32, 64), pick(hexes.upper(), 32, 48), pick(alnum, 20, 48), "ghp_" + pick(alnum, 36, 36), "AKIA" + pick(string.ascii_uppercase + string.digits, 16, 16), "sk-" + pick(alnum, 40, 48), pick(alnum + "+/", 40, 64)])
            name = rng.choice(["token", "api_key", "secret", "password", "auth_token", "client_secret", "access_key", "TOKEN", "API_KEY", "private_key"])
            how = rng.choice([(f"{name} = \"", "\""), (f"{name}=", ""), (f"{name}: ", ""), (f"\"{name}\": \"", "\","), ("Authorization: Bearer ", ""), (f"export {name.upper()}='", "'"), (f"{name} = \"", "\"!!")])
            out.append((talk + how[0], key, how[1] + more, 1.0))
            continue
        kind = rng.randrange(9)
        if kind == 0:
            out.append((talk + rng.choice(["commit ", "sha256: ", "checksum = \"", "md5 ", "digest: ", "revision "]), pick(hexes, 32, 64), more, 0.0))
        elif kind == 1:
            out.append((talk + rng.choice(["id ", "uuid: ", "request "]), "-".join(pick(hexes, k, k) for k in (8, 4, 4, 4, 12)), more, 0.0))
        elif kind == 2:
            out.append((talk + rng.choice(["", "https://www.", "see http://"]), "/".join([word(), "home", "data", word() + str(rng.randint(1, 99)), "index" + str(rng.randint(1, 9))]), ".html" + more, 0.0))
        elif kind == 3:
            out.append((talk, pick(string.digits, 16, 20), more, 0.0))
        elif kind == 4:
            out.append((talk, "".join(w.capitalize() if k else w for k, w in enumerate([word(), word(), word(), word(), "value"])) + "Table", "()" + more, 0.0))
        elif kind == 5:
            out.append((talk, "_".join([word(), "test", word(), "version", str(rng.randint(1, 999))]).ljust(16, "0"), more, 0.0))
        elif kind == 6:
            out.append((talk + rng.choice(["token = \"", "secret: ", "password="]), rng.choice(["your-token-goes-here-1", "example_value_0001", "xxxxxxxxxxxxxxxx1", "changeme_changeme_1", "insert_token_here_2", "00000000000000000000"]), "\"" + more, 0.0))
        elif kind == 7:
            out.append((talk + word() + ".", "".join(word() for _ in range(5)).ljust(14, "e") + str(rng.randint(10, 99)), "@mail" + more, 0.0))
        else:
            out.append((talk + "data:image/png;base64,", pick(alnum + "+/", 300, 600), more, 0.0))
    return out


def train(spark: SparkSession, findings: list[tuple[str, str, str, float]] | None = None) -> list[Node]:
    """The forest of labelled findings (before, core, after, label), a list of bounded size."""
    rows = findings or labelled_findings()
    x, y = [], []
    for i in range(0, len(rows), 120):
        made = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("before", "core", "after", "label"), r, strict=True)]) for r in rows[i : i + 120]])
        table = spark.range(1).select(F.inline(made))
        for r in table.select(features(F.col("core"), F.col("before"), F.col("after")).alias("f"), "label").collect():
            x.append(r.f)
            y.append(r.label)
    return grow_forest(np.array(x), np.array(y))


def findings(text: Column, forest: list[Node]) -> Column:
    """Array of (start, core, score) of a text's candidates; null if it has none."""

    def scored(c: Column) -> Column:
        score = let(features(c["core"], c["before"], c["after"]), lambda f: forest_column(forest, f))
        return F.struct(c["start"].alias("start"), c["core"].alias("core"), score.alias("score"))

    return F.transform(candidates(text), scored)


def scan(docs: DataFrame, forest: list[Node], threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: doc_id, start, length, secret_sha256, score, is_secret."""
    rows = docs.select("doc_id", F.explode(findings(F.col("text"), forest)).alias("x"))
    return rows.select(
        "doc_id",
        "x.start",
        F.length("x.core").cast("long").alias("length"),
        F.sha2("x.core", 256).alias("secret_sha256"),
        F.round("x.score", 6).alias("score"),
        (F.col("x.score") >= threshold).alias("is_secret"),
    )


def redact(docs: DataFrame, forest: list[Node], threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """docs with every secret replaced by mask; texts without one, and all other columns, as they were."""
    secret = F.transform(F.filter(findings(F.col("text"), forest), lambda x: x["score"] >= threshold), lambda x: x["core"])
    # Longest first, so that a secret inside another one is not cut out of it.
    ordered = F.reverse(F.array_sort(F.transform(F.array_distinct(secret), lambda c: F.struct(F.length(c).alias("n"), c.alias("core")))))
    clean = F.aggregate(ordered, F.col("text"), lambda t, x: F.replace(t, x["core"], F.lit(mask)))
    return docs.withColumn("text", F.coalesce(clean, F.col("text")))
