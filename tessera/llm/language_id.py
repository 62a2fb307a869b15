"""Language ID (operator 4): prediction by partial matching over bytes.

Each language has a byte context tree of up to ORDER bytes with the counts of what followed. The code length of a byte
is that of the longest context the language knows: log2((n + d) / c) if the byte followed it c times of n, d being the
number of different bytes seen there, else an escape of log2((n + d) / d) and the next shorter context; below the empty
context every byte costs 8 bits. Counts are frozen after training, so a text's code length is a sum over its bytes and
exact for texts of any length, block by block. The language with the shortest code wins, and the score is its share of
2^-length over all languages.

The trees of all languages are merged: a context or a (context, byte) pair that any language has gets a number, and a
table holds one cost for each language; only pairs that no language has are escaped at scoring time.

Learning uses about SAMPLE documents of each language, so what reaches the driver stays bounded.

Edge cases: null texts and texts without a letter are `und` with score 0, as is everything if nothing could be learned;
rows with a null lang are not learned from; repeated rows and null ids are scored like others; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blocks, bounded_sample, crc_mod, flat, small_batches

ORDER = 3
#: Documents of each language that are learned from, in expectation, and the bytes of one that count.
SAMPLE = 500
BLOCK = 1 << 19
START = 10  # the byte that stands before a text's first


@dataclass
class Trees:
    """langs; symbol of each byte; grams[k]: number of each (k + 1)-gram or -1; cost[k] by gram; escape[k] by context."""

    langs: list[str]
    symbol: np.ndarray
    size: int
    trigram: np.ndarray
    fourgram: np.ndarray
    bigram: np.ndarray
    cost: list[np.ndarray]
    escape: list[np.ndarray]


def _padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, each with ORDER start bytes before it; and the positions of the texts' own bytes."""
    n = np.diff(offsets)
    own = np.arange(len(raw)) + np.repeat(ORDER * np.arange(1, len(n) + 1), n)
    out = np.full(len(raw) + ORDER * len(n), START, np.uint8)
    out[own] = raw
    return out, own


def fit(texts: dict[str, list[bytes]]) -> Trees:
    """Count the contexts of each language's texts and merge the trees."""
    langs = sorted(texts)
    arrays = []
    for lang in langs:
        raw = np.frombuffer(b"".join(texts[lang]), np.uint8)
        n = np.array([len(t) for t in texts[lang]])
        starts = np.cumsum(np.r_[0, n + ORDER])
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], n + ORDER)  # of each byte within its own text
        arrays.append((_padded(raw, np.cumsum(np.r_[0, n]))[0], place))
    seen = np.unique(np.concatenate([a for a, _ in arrays] + [np.array([START], np.uint8)]))
    symbol = np.zeros(256, np.int32)
    symbol[seen] = np.arange(1, len(seen) + 1)
    size, n_langs = len(seen) + 1, len(langs)

    grams: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for k in range(ORDER + 1):
        found = []
        for a, place in arrays:
            s = symbol[a].astype(np.int64)
            at = np.flatnonzero(place >= k)  # the start bytes count as text, so that they are contexts
            code = np.zeros(len(at), np.int64)
            for back in range(k, -1, -1):
                code = code * size + s[at - back]
            found.append(np.unique(code, return_counts=True))
        codes = np.unique(np.concatenate([c for c, _ in found])) if found else np.zeros(0, np.int64)
        c = np.zeros((len(codes), n_langs))
        for j, (x, m) in enumerate(found):
            c[np.searchsorted(codes, x), j] = m
        grams.append(codes)
        counts.append(c)

    cost: list[np.ndarray] = []
    escape: list[np.ndarray] = []
    for k in range(ORDER + 1):
        context, c = grams[k] // size, counts[k]
        if k == 0:
            n, d = c.sum(0, keepdims=True), (c > 0).sum(0, keepdims=True)
            esc = np.where(n > 0, np.log2((n + d) / np.maximum(d, 1) + (n == 0)), 0.0)
            low = np.full((size, n_langs), 8.0)
            full = np.zeros((size, n_langs))
            full[grams[0]] = c
            cost.append(np.where(full > 0, np.log2(np.maximum(n + d, 1) / np.maximum(full, 1)), esc + low).astype(np.float32))
            escape.append(esc.astype(np.float32))
            continue
        # A context of k bytes is a gram of the level below, as the start bytes were counted too.
        at = np.searchsorted(grams[k - 1], context)
        n = np.zeros((len(grams[k - 1]), n_langs))
        d = np.zeros_like(n)
        np.add.at(n, at, c)
        np.add.at(d, at, c > 0)
        esc = np.where(n > 0, np.log2((n + d) / np.maximum(d, 1) + (n == 0)), 0.0)
        shorter = grams[k] % size**k
        below = cost[k - 1][shorter if k == 1 else np.searchsorted(grams[k - 1], shorter)]
        own = np.log2(np.maximum((n + d)[at], 1) / np.maximum(c, 1))
        cost.append(np.where(c > 0, own, esc[at] + below).astype(np.float32))
        escape.append(esc.astype(np.float32))

    def table(codes: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, -1, np.int32)
        out[codes] = np.arange(len(codes))
        return out

    trigram = table(grams[2], size**3)
    four = np.full((len(grams[2]) + 1) * size, -1, np.int32)
    owner = trigram[grams[3] // size]
    four[owner * size + grams[3] % size] = np.arange(len(owner))
    return Trees(langs, symbol, size, trigram, four, table(grams[1], size**2), cost, escape)


def code_lengths(raw: np.ndarray, offsets: np.ndarray, t: Trees) -> np.ndarray:
    """Bits of each text under each language."""
    out = np.zeros((len(offsets) - 1, len(t.langs)))
    for i, j in blocks(offsets, BLOCK):
        a, b = int(offsets[i]), int(offsets[j])
        if j == i + 1 and b - a > 4 * BLOCK:  # a very long text: its code length is a sum over pieces with their contexts
            for lo in range(a, b, BLOCK):
                hi, left = min(b, lo + BLOCK), min(lo - a, ORDER)
                piece = raw[lo - left : hi]
                out[i] += _bits(piece, np.array([0, len(piece)]), t, left)[0]
        else:
            out[i:j] = _bits(raw[a:b], offsets[i : j + 1] - a, t)
    return out


def _bits(raw: np.ndarray, offsets: np.ndarray, t: Trees, skip: int = 0) -> np.ndarray:
    """Sums over each text's bytes; the first `skip` bytes only serve as context (of a single text)."""
    n_texts = len(offsets) - 1
    if not len(raw):
        return np.zeros((n_texts, len(t.langs)))
    data, own = _padded(raw, offsets)
    s = t.symbol[data]
    two = s[:-1] * t.size + s[1:]  # the pair that ends at index + 1
    three = t.trigram[two[:-1] * t.size + s[2:]]  # the trigram that ends at index + 2
    own = own[skip:]
    before, now = three[own - 3], s[own]
    e = t.fourgram[np.where(before >= 0, before, len(t.fourgram) // t.size - 1) * t.size + now]
    bits = t.cost[3][np.maximum(e, 0)]
    miss = np.flatnonzero(e < 0)
    if len(miss):
        at, ctx = own[miss], before[miss]
        more = np.where((ctx >= 0)[:, None], t.escape[3][np.maximum(ctx, 0)], 0)
        g = three[at - 2]
        part = t.cost[2][np.maximum(g, 0)]
        deep = np.flatnonzero(g < 0)
        if len(deep):
            at2 = at[deep]
            ctx2 = t.bigram[two[at2 - 2]]
            more[deep] += np.where((ctx2 >= 0)[:, None], t.escape[2][np.maximum(ctx2, 0)], 0)
            g1 = t.bigram[two[at2 - 1]]
            low = t.cost[1][np.maximum(g1, 0)]
            none = np.flatnonzero(g1 < 0)
            if len(none):
                at3 = at2[none]
                ctx1 = s[at3 - 1]
                known = ctx1 > 0
                esc = np.where(known[:, None], t.escape[1][np.maximum(ctx1 - 1, 0)], 0)
                low[none] = esc + t.cost[0][s[at3]]
            part[deep] = low
        bits[miss] = more + part
    lens = np.diff(offsets)
    lens[0] -= skip
    sums = np.concatenate([np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0, dtype=np.float64)])
    ends = np.cumsum(lens)
    return sums[ends] - sums[ends - lens]


def train(docs: DataFrame, most: int = SAMPLE) -> Trees | None:
    """Fit on about `most` documents of each language that occurs."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    texts: dict[str, list[bytes]] = {}
    for r in bounded_sample(rows, "lang", most).collect():
        texts.setdefault(r.lang, []).append(r.text.encode())
    return fit(texts) if texts else None


def predict(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, lang_pred string, score double"
    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter = np.array(batch.column(2).to_pylist(), dtype=bool)
            pred, score = ["und"] * len(letter), np.zeros(len(letter))
            if trees is not None and len(letter):
                bits = code_lengths(*flat(batch.column(1)), trees)
                best = bits.argmin(1)
                share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -60)).sum(1)
                pred = [trees.langs[k] if ok else "und" for k, ok in zip(best, letter, strict=True)]
                score = np.where(letter, share, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def language_id(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Learn from rows whose crc32(doc_id) mod 5 is not 0, predict all: doc_id, held_out, lang_pred, score."""
    trees = train(docs.filter(crc_mod(F.col("doc_id"), 5) != 0), most)
    out = predict(docs, trees)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
