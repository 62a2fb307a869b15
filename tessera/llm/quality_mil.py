"""Quality classifier (operator 7): attention-based multiple-instance learning.

A document is a bag of passages of WORDS words. Every passage is encoded from what it consists of: kinds of bytes, pairs
of bytes (hashed), lengths and capitals of words, how many words are new within it and how many repeat the one before.
A small network maps a passage to h = tanh(W x + b); a gate gives it the weight

    a = softmax over the bag of  w . (tanh(V h) * sigmoid(U h)),

and the document's score is sigmoid(c . sum(a h) + d). All weights are learned together, by Adam, from the documents'
labels alone, on at most SAMPLE documents of each label; passages have no labels. Every passage of every text is scored.

Edge cases: null, empty and blank texts are a bag of one passage without words; very long texts are read in cuts at passages,
which changes nothing; without labels of both kinds every score is 0.5; repeated rows, ties and null ids are scored like
others; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blocks, bounded_sample, crc_mod, flat, mix64, small_batches

WORDS = 64
#: Documents of each label that are learned from, in expectation.
SAMPLE = 1500
HIDDEN, GATE = 24, 12
PAIRS = 64
BLOCK = 1 << 19
THRESHOLD = 0.3


def _kinds() -> np.ndarray:
    """Small letters, capitals, digits, blanks, line ends, bytes over 127, and the signs of ASCII one by one."""
    kind = np.zeros(256, np.int64)
    kind[65:91], kind[48:58], kind[[9, 11, 12, 13, 32]], kind[10], kind[128:] = 1, 2, 3, 4, 5
    kind[[*range(0, 9), *range(14, 32), 127]] = 6
    for k, b in enumerate([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]):
        kind[b] = 7 + k
    return kind


KIND = _kinds()
N_KINDS = int(KIND.max()) + 1
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
N_FEATURES = N_KINDS + PAIRS + 7


def passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The encoded passages of all texts, and the text of each; every text has one at least."""
    xs, of = [], []
    for i, j in blocks(offsets, BLOCK):
        a, b = int(offsets[i]), int(offsets[j])
        parts = _long(raw[a:b]) if j == i + 1 and b - a > BLOCK else [_encode(raw[a:b], offsets[i : j + 1] - a)]
        for x, t in parts:
            xs.append(x)
            of.append(t + i)
    if not xs:
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0, np.int64)
    return np.concatenate(xs), np.concatenate(of)


def _starts(raw: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Where words begin in raw[lo:hi]."""
    blank = BLANK[raw[max(0, lo - 1) : hi]]
    return lo + np.flatnonzero(~blank & np.r_[True, blank[:-1]]) if not lo else lo + np.flatnonzero(~blank[1:] & blank[:-1])


def _long(raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The passages of one long text, in cuts that begin where a passage does: the same as in one piece."""
    words = sum(len(_starts(raw, lo, min(len(raw), lo + BLOCK))) for lo in range(0, len(raw), BLOCK))
    a = at = 0  # where the passage begins, and how far words have been looked for
    held: list[np.ndarray] = []
    while a < len(raw):
        while at < len(raw) and (at - a < BLOCK or sum(map(len, held)) <= WORDS):
            held.append(_starts(raw, at, min(len(raw), at + BLOCK)))
            at = min(len(raw), at + BLOCK)
        start = np.concatenate(held) if held else np.zeros(0, np.int64)
        if at == len(raw):
            yield _encode(raw[a:], np.array([0, len(raw) - a]), words)
            return
        k = (len(start) - 1) // WORDS * WORDS
        end = int(start[k])
        # The next passage's first byte comes along, for the pair it ends, and its passage is left out.
        x, t = _encode(raw[a : end + 1], np.array([0, end + 1 - a]), words)
        yield x[:-1], t[:-1]
        a, held = end, [start[k:]]


def _encode(raw: np.ndarray, offsets: np.ndarray, words_of_text: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The passages of texts and the text of each. words_of_text: of the text that raw is a cut of."""
    n = len(offsets) - 1
    lens = np.diff(offsets)
    text_of_byte = np.repeat(np.arange(n), lens)
    blank = BLANK[raw] if len(raw) else np.zeros(0, bool)
    first = np.zeros(len(raw), bool)
    first[offsets[:-1][lens > 0]] = True
    start = np.flatnonzero(~blank & (np.concatenate([[True], blank[:-1]]) | first)) if len(raw) else np.zeros(0, np.int64)
    word_text = text_of_byte[start] if len(raw) else start
    per_text = np.bincount(word_text, minlength=n)
    in_text = np.arange(len(start)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    bags = np.maximum(1, -(-per_text // WORDS))
    base = np.cumsum(bags) - bags
    total = int(bags.sum())
    word_bag = base[word_text] + in_text // WORDS
    # A byte belongs to the passage of the last word that began, at a text's start to its first passage.
    began = np.zeros(len(raw), np.int64)
    began[start] = 1
    at = np.cumsum(began) - 1
    byte_bag = np.where((at >= 0) & (word_text[np.maximum(at, 0)] == text_of_byte), word_bag[np.maximum(at, 0)], base[text_of_byte]) if len(start) else base[text_of_byte]
    x, put = np.zeros((total, N_FEATURES), np.float32), N_KINDS + PAIRS
    size = np.bincount(byte_bag, minlength=total).astype(np.float32)
    kind = KIND[raw]
    x[:, :N_KINDS] = np.bincount(byte_bag * N_KINDS + kind, minlength=total * N_KINDS).reshape(total, N_KINDS) / (size[:, None] + 1)
    if len(raw) > 1:
        pair = (raw[:-1].astype(np.int64) * 31 + raw[1:]) * 0x9E3779B1 >> 12 & (PAIRS - 1)
        code = (byte_bag[:-1] * PAIRS + pair)[~first[1:]]  # no pair goes from one text to the next
        x[:, N_KINDS : N_KINDS + PAIRS] = np.bincount(code, minlength=total * PAIRS).reshape(total, PAIRS) / (size[:, None] + 1)
    x[:, : N_KINDS + PAIRS] = np.sqrt(x[:, : N_KINDS + PAIRS])
    if len(start):
        end = np.concatenate([start[1:], [len(raw)]])
        sums = np.concatenate([[0], np.cumsum(~blank)])
        length = (sums[end] - sums[start]).astype(np.float32)
        code = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(raw.astype(np.uint64) + np.uint64(1)) * ~blank * _place(start, len(raw)))])
        word = mix64(code[end] - code[start] + length.astype(np.uint64))
        words = np.bincount(word_bag, minlength=total).astype(np.float32)
        again = np.zeros(len(start), np.float32)
        again[1:] = (word[1:] == word[:-1]) & (word_bag[1:] == word_bag[:-1])
        key = np.sort((word_bag.astype(np.uint64) << np.uint64(40)) | (word >> np.uint64(24)))
        new = np.ones(len(key), np.float32)
        new[1:] = key[1:] != key[:-1]
        w1 = words + 1
        x[:, put] = words / WORDS
        x[:, put + 1] = np.bincount(word_bag, weights=length, minlength=total) / w1 / 10
        x[:, put + 2] = np.bincount(word_bag, weights=again, minlength=total) / w1
        x[:, put + 3] = np.bincount((key >> np.uint64(40)).astype(np.int64), weights=new, minlength=total) / w1
        x[:, put + 4] = np.bincount(word_bag, weights=(length > 12), minlength=total) / w1
        x[:, put + 5] = np.bincount(word_bag, weights=(KIND[raw[start]] == 1), minlength=total) / w1
    x[:, put + 6] = np.log1p(per_text if words_of_text is None else np.array([words_of_text])).repeat(bags) / 8
    return x, np.repeat(np.arange(n), bags)


def _place(start: np.ndarray, n: int) -> np.ndarray:
    """1 + each byte's place in its word; what stands before the first word has place 0."""
    lead = np.zeros(int(start[0]), np.uint64)
    gap = np.diff(np.concatenate([start, [n]]))
    return np.concatenate([lead, 1 + np.arange(int(gap.sum()), dtype=np.uint64) - np.repeat(np.cumsum(gap) - gap, gap).astype(np.uint64)])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def forward(x: np.ndarray, of: np.ndarray, p: dict[str, np.ndarray]) -> tuple[np.ndarray, tuple]:
    """The score of each bag (their numbers rise without gaps), and what the gradient needs."""
    h = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (t * s) @ p["w"]
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    top = np.maximum.reduceat(e, starts)
    count = np.diff(np.r_[starts, len(of)])
    u = np.exp(e - np.repeat(top, count))
    a = u / np.repeat(_sums(u, starts), count)
    z = _sums(a[:, None] * h, starts)
    score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
    return score, (h, t, s, a, z, starts, count)


def gradient(x: np.ndarray, y: np.ndarray, weight: np.ndarray, score: np.ndarray, held: tuple, p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Of the weighted logistic loss."""
    h, t, s, a, z, _, count = held
    g = weight * (score - y) / weight.sum()
    dz = np.repeat(g[:, None] * p["c"], count, axis=0)
    da = (dz * h).sum(1)
    starts = held[5]
    de = a * (da - np.repeat(_sums(a * da, starts), count))
    dts = de[:, None] * p["w"]
    dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
    return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ g, "d": np.array(g.sum())}


def fit(texts: list[str], labels: np.ndarray, steps: int = 240, seed: int = 2, penalty: float = 1e-4) -> Model | None:
    """Learn from texts and 0/1 labels; None without labels of both kinds."""
    if len(set(labels.tolist())) < 2:
        return None
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    x, of = passages(raw, np.cumsum([0] + [len(t.encode()) for t in texts]))
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    rng = np.random.default_rng(seed)
    init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"W": init(x.shape[1], HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE), "w": init(GATE), "c": init(HIDDEN), "d": np.zeros(())}
    y = labels.astype(np.float32)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    m, v = ({k: np.zeros_like(q, dtype=np.float64) for k, q in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        score, held = forward(x, of, p)
        for k, g in gradient(x, y, weight, score, held, p).items():
            g = g + penalty * p[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] = (p[k] - 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(mean, scale, p)


def scores(raw: np.ndarray, offsets: np.ndarray, model: Model | None) -> np.ndarray:
    n = len(offsets) - 1
    if model is None or not n:
        return np.full(n, 0.5)
    x, of = passages(raw, offsets)
    return forward(((x - model.mean) / model.scale).astype(np.float32), of, model.p)[0].astype(np.float64)


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, label: str = "quality") -> Model | None:
    """Fit on about `most` documents of each label."""
    rows = labels.filter(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    picked = bounded_sample(rows, "label", most)
    # The sample of ids is bounded, so it may be broadcast; the texts then need no shuffle.
    got = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").orderBy("doc_id").collect()
    return fit([r.text or "" for r in got], np.array([r.label for r in got], dtype=np.int64))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(scores(*flat(batch.column(1)), model), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) mod 5 is not 0, score all: doc_id, held_out, score, predicted."""
    model = train(docs, labels.filter(crc_mod(F.col("doc_id"), 5) != 0), most)
    return score(docs, model).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
