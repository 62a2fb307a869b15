"""Toxicity (operator 2): a subsequence string-kernel support vector machine with Nyström landmarks.

Kernel. A string's features are its subsequences of four symbols, one symbol a code point, in which each step skips at
most one symbol, or goes from a letter to the next one over a run of up to GAP symbols that are not letters; weighted
DECAY per skipped symbol, a run counting as two. The kernel of two strings is the product of their feature vectors,
hashed to 2^BITS coordinates. A skipped symbol may be a blank, a dot, a star or any other inserted character, so "id*iot"
and "idi -- ot" share the features of "idiot". Three or more letters that stand alone, with runs of up to GAP other
symbols between them, are read as one word: "i d i o t", "i--d--i--o--t", "i · d · i · o · t". Look-alike digits and
signs are read as letters, capitals as small letters.

Learning. Sentences of labelled documents carry their document's label. Landmarks are the words whose presence tells
most about the label, and some ordinary ones. Sentences are mapped to k(x, landmarks) K^-1/2 and a squared-hinge SVM
is fitted in that space by Newton steps; then, as most sentences of a toxic document are harmless, only the highest-scoring
ones of it stay positive and the machine is fitted again. About SAMPLE documents of each label are used (the parameter `most`), with
all their sentences.

Scoring. The machine is linear in the hashed features, so it collapses to one table of weights. A document's weights
are summed over windows of WIDTH symbols, the excursions above a few levels counted, and a logistic regression of
counts and rates, fitted on the same training documents, gives the score. Whole texts are read, in blocks.

Edge cases: null and empty texts have no excursion and get the score of such a document; without training rows of both
labels every score is 0; very long texts are read in overlapping pieces, which changes nothing; ties, repeated rows and null
ids are scored like others; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blocks, bounded_sample, crc_mod, flat, small_batches

BITS = 18
DECAY = 0.8
WIDTH = 10
#: Blanks around texts: more than a window and a subsequence reach, so that neighbours never meet.
PAD, REACH = 16, 8
#: Symbols other than letters that a step, or the join of a spelled word, goes over at most (less than PAD).
GAP = 12
#: Documents of each label that the machine learns from, in expectation.
SAMPLE = 1200
LANDMARKS, PLAIN = 288, 32
#: Sentences of a toxic document that stay positive in the second fit.
TOP = 4
BLOCK = 1 << 20
THRESHOLD = 0.7

#: Signs and digits that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: The offsets of the eight subsequences: each of three steps is one or two symbols long.
STEPS = [np.cumsum([a, b, c]) for a in (1, 2) for b in (1, 2) for c in (1, 2)]


def _symbols() -> np.ndarray:
    """Of each code point below 2^17: 0 blank, 1 to 26 letters, 27 digit, 28 sign, 32 and more other letters."""
    table = np.full(1 << 17, 28, np.uint8)
    for b in range(128, 1 << 17):
        kind = unicodedata.category(chr(b))[0]
        table[b] = 0 if kind == "Z" else 32 + (b & 31) if kind in "LN" else 28
    for k, ch in enumerate("abcdefghijklmnopqrstuvwxyz"):
        table[ord(ch)] = table[ord(ch.upper())] = k + 1
    for ch in "0123456789":
        table[ord(ch)] = 27
    for a, b in LOOKALIKES.items():
        table[ord(a)] = table[ord(b)]
    table[[9, 10, 11, 12, 13, 32]] = 0
    return table


SYMBOLS = _symbols()
LETTER = np.array([1 <= k <= 26 or k >= 32 for k in range(64)])


def _code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of UTF-8 bytes, one for each code point, and where each text starts among them."""
    out = SYMBOLS[raw]
    tail = (raw & 0xC0) == 0x80
    at = np.flatnonzero(raw >= 0xC0)
    if not len(at):
        return out, offsets
    lead = raw[at].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & (0x7F >> size)
    for k in (1, 2, 3):
        more = size > k
        point[more] = (point[more] << 6) | (raw[at[more] + k] & 0x3F)
    out[at] = np.where(point < len(SYMBOLS), SYMBOLS[np.minimum(point, len(SYMBOLS) - 1)], 32 + (point & 31))
    return out[~tail], offsets - np.searchsorted(np.flatnonzero(tail), offsets)


def decoded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of texts, without what stands between the letters of words spelled out; where each text starts."""
    s, offsets = _code_points(raw, np.asarray(offsets))
    letter = LETTER[s]
    inner = offsets[(offsets > 0) & (offsets < len(s))]
    before, after = np.r_[False, letter[:-1]], np.r_[letter[1:], False]
    before[inner], after[inner - 1] = False, False
    alone = np.flatnonzero(letter & ~before[: len(s)] & ~after[: len(s)])
    if len(alone) < 3:
        return s, offsets
    a, gap = alone[:-1], np.diff(alone) - 1
    text = np.searchsorted(offsets, alone, side="right")
    link = (gap <= GAP) & (text[1:] == text[:-1])
    for k in range(1, GAP):
        link &= (k > gap) | ~letter[np.minimum(a + k, len(s) - 1)]
    link &= np.r_[False, link[:-1]] | np.r_[link[1:], False]
    gap = gap[link]
    drop = np.repeat(a[link] + 1, gap) + np.arange(gap.sum()) - np.repeat(np.cumsum(gap) - gap, gap)
    return np.delete(s, drop), offsets - np.searchsorted(drop, offsets)


def _hashed(a, b, c, d) -> np.ndarray:
    code = (a << np.uint32(18)) | (b << np.uint32(12)) | (c << np.uint32(6)) | d
    code *= np.uint32(0x9E3779B1)
    code >>= np.uint32(32 - BITS)
    return code


def _over_runs(s: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """The subsequences that start below n and go over a run of two or more symbols: starts, hashes and their weight."""
    letter = LETTER[s]
    at = np.flatnonzero(letter[:-2] & ~letter[1:-1] & ~letter[2:])
    far = np.zeros(len(at), np.int64)
    for d in range(GAP + 1, 2, -1):
        far[letter[np.minimum(at + d, len(s) - 1)]] = d
    at, far = at[far > 0], far[far > 0]
    hop = np.zeros(len(s), np.uint8)
    hop[at] = far

    def go(start: np.ndarray, read: list[np.ndarray], now: np.ndarray, weight: float) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        if len(read) == 4:
            yield start, _hashed(*read), weight
            return
        for step in (1, 2):
            yield from go(start, [*read, s[now + step]], now + step, weight * DECAY ** (step - 1))
        on = hop[now] > 0
        if on.any():
            to = now[on] + hop[now[on]]
            yield from go(start[on], [*[x[on] for x in read], s[to]], to, weight * DECAY**2)

    # The first hop comes after none, one or two short steps.
    for steps in ((), (1,), (2,), (1, 1), (1, 2), (2, 1), (2, 2)):
        start = at - sum(steps)
        on = (start >= 0) & (start < n)
        if on.any():
            start, to = start[on], at[on] + far[on]
            read = [s[start + k] for k in np.cumsum([0, *steps])]
            yield from go(start, [*read, s[to]], to, DECAY ** (sum(steps) - len(steps) + 2))


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashed subsequences of one string and their weights."""
    s, _ = decoded(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    n = len(s)
    s = np.concatenate([s, np.zeros(REACH, np.uint8)]).astype(np.uint32)
    idx = [_hashed(s[:n], s[i : i + n], s[j : j + n], s[k : k + n]) for i, j, k in STEPS]
    w = [np.full(n, DECAY ** int(k - 3), np.float32) for _, _, k in STEPS]
    for start, code, weight in _over_runs(s, n):
        idx.append(code)
        w.append(np.full(len(start), weight, np.float32))
    return np.concatenate(idx), np.concatenate(w)


def padded(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts in one array with PAD blanks around each; and where each starts, and the end."""
    n = np.diff(offsets)
    starts = offsets + PAD * np.arange(1, len(offsets) + 1)
    out = np.zeros(int(starts[-1]), np.uint8)
    to = np.arange(len(symbols)) + np.repeat(PAD * np.arange(1, len(n) + 1), n)
    out[to] = symbols
    return out, starts


def responses(symbols: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The summed weights of the subsequences that start in each window of WIDTH symbols."""
    s = symbols.astype(np.uint32)
    n = len(s) - REACH
    if n <= 0:
        return np.zeros(0, np.float32)
    total = np.zeros(n, np.float32)
    for i, j, k in STEPS:
        total += np.float32(DECAY ** int(k - 3)) * weights[_hashed(s[:n], s[i : i + n], s[j : j + n], s[k : k + n])]
    for start, code, weight in _over_runs(s, n):
        total[start] += np.float32(weight) * weights[code]
    sums = np.concatenate([[0.0], np.cumsum(total, dtype=np.float64)])
    hi = np.minimum(np.arange(n) + WIDTH, n)
    return (sums[hi] - sums[:n]).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    levels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    coef: np.ndarray = field(default_factory=lambda: np.zeros(0))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    empty: bool = False


def counts(raw: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Of each text: its words, and its excursions above each level."""
    out = np.zeros((len(offsets) - 1, 1 + len(model.levels)))
    symbols, offsets = decoded(raw, offsets)
    for i, j in blocks(offsets, BLOCK):
        a, b = int(offsets[i]), int(offsets[j])
        if j == i + 1 and b - a > 4 * BLOCK:  # a very long text, piece by piece with an overlap
            for lo in range(a, b, BLOCK):
                hi, left = min(b, lo + BLOCK), min(lo - a, 1)
                right = min(b - hi, WIDTH + 3 * (GAP + 1))
                out[i] += _block(symbols[lo - left : hi + right], np.array([0, hi + right - lo + left]), model, left, hi - lo)[0]
        else:
            out[i:j] = _block(symbols[a:b], offsets[i : j + 1] - a, model)
    return out


def _block(symbols: np.ndarray, offsets: np.ndarray, model: Model, left: int = 0, own: int | None = None) -> np.ndarray:
    symbols, starts = padded(symbols, offsets)
    r = responses(symbols, model.weights)
    n = len(offsets) - 1
    out = np.zeros((n, 1 + len(model.levels)))
    low = PAD + left if left else 0
    stop = len(symbols) if own is None else PAD + left + own
    rises = [np.flatnonzero((symbols[1:] > 0) & (symbols[:-1] == 0)) + 1]
    for level in model.levels:
        up = r > level
        rises.append(np.flatnonzero(up & ~np.concatenate([[False], up[:-1]])))
    for k, at in enumerate(rises):
        at = at[(at >= low) & (at < stop)]
        # A window that starts WIDTH before a text can only hold that text.
        of = np.searchsorted(starts - WIDTH, at, side="right") - 1
        out[:, k] = np.bincount(of[of >= 0], minlength=n)[:n]
    return out


def _design(c: np.ndarray) -> np.ndarray:
    words = c[:, :1]
    return np.hstack([np.log1p(words), np.log1p(c[:, 1:]), 100 * c[:, 1:] / (words + 10), np.sqrt(c[:, 1:] / (words + 1))])


def scores(raw: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    n = len(offsets) - 1
    if model.empty:
        return np.zeros(n)
    x = (_design(counts(raw, offsets, model)) - model.mean) / model.scale
    return 1 / (1 + np.exp(-np.clip(np.hstack([x, np.ones((n, 1))]) @ model.coef, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 40) -> np.ndarray:
    """Coefficients (the last is the intercept) by damped Newton steps; both classes weigh as they occur."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def svm(z: np.ndarray, y: np.ndarray, c: np.ndarray, steps: int = 25, rows: int = 1 << 13) -> np.ndarray:
    """Squared-hinge support vector machine with one cost per row, by Newton steps; the last entry is the bias.

    The rows are read in blocks, so that besides z only a few MB are held.
    """
    ridge = np.ones(z.shape[1] + 1)
    ridge[-1] = 1e-6
    w = np.zeros(len(ridge))
    for _ in range(steps):
        grad, hessian = ridge * w, np.diag(ridge)
        for lo in range(0, len(z), rows):
            part = np.hstack([z[lo : lo + rows], np.ones((len(z[lo : lo + rows]), 1), z.dtype)])
            slack = 1 - y[lo : lo + rows] * (part @ w)
            on = slack > 0
            part, cost = part[on].astype(np.float64), c[lo : lo + rows][on]
            grad -= 2 * part.T @ (cost * y[lo : lo + rows][on] * slack[on])
            hessian += 2 * (part * cost[:, None]).T @ part
        step = np.linalg.solve(hessian, grad)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    return w


_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]?")


def landmarks(texts: list[str], labels: np.ndarray, rng: np.random.Generator) -> list[str]:
    """The words whose document counts differ most between the labels, and PLAIN frequent ones."""
    seen: list[Counter] = [Counter(), Counter()]
    for text, label in zip(texts, labels, strict=True):
        seen[int(label)].update(set(_WORD.findall(text.lower())))
    n1, n0 = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    gain = {}
    for w, k in seen[1].items():
        p, q = (k + 0.5) / (n1 + 1), (seen[0][w] + 0.5) / (n0 + 1)
        if len(w) >= 2 and k >= 3 and p > 2 * q:
            gain[w] = k * np.log(p / q)
    best = sorted(gain, key=lambda w: (-gain[w], w))[: LANDMARKS - PLAIN]
    rest = sorted(w for w in seen[0] if len(w) >= 4 and w not in gain)
    plain = [rest[i] for i in rng.choice(len(rest), min(PLAIN, len(rest)), replace=False)] if rest else []
    return best + plain


def fit(texts: list[str], labels: np.ndarray, seed: int = 5) -> Model:
    """Learn from texts and their 0/1 labels."""
    size = 1 << BITS
    rng = np.random.default_rng(seed)
    marks = landmarks(texts, labels, rng) if len(set(labels.tolist())) == 2 else []
    if not marks:
        return Model(np.zeros(size, np.float32), empty=True)
    # Landmark features: a row of `rows` for each hashed coordinate that any landmark has.
    found = [features(f" {m} ".encode()) for m in marks]
    used = np.unique(np.concatenate([f for f, _ in found]))
    row = np.full(size, -1, np.int32)
    row[used] = np.arange(len(used))
    phi = np.zeros((len(used), len(marks)), np.float32)
    for j, (f, w) in enumerate(found):
        np.add.at(phi[:, j], row[f], w)
    phi /= np.sqrt((phi**2).sum(0))
    values, vectors = np.linalg.eigh((phi.T @ phi).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])

    sentences, of, y = [], [], []
    for d, (text, label) in enumerate(zip(texts, labels, strict=True)):
        own = [s for s in _SENTENCE.findall(text) if len(s) > 3]
        sentences += own
        of += [d] * len(own)
        y += [1.0 if label else -1.0] * len(own)

    def mapped(sentences: list[str]) -> np.ndarray:
        z = np.zeros((len(sentences), int(keep.sum())), np.float32)
        for i, s in enumerate(sentences):
            raw = s.encode()
            f, w = features(raw)
            r = row[f]
            hit = r >= 0
            z[i] = (w[hit] @ phi[r[hit]]) @ root / np.sqrt(len(raw) + 20)
        return z

    z = mapped(sentences)
    y, of = np.array(y), np.array(of)

    cost = np.where(y > 0, 1.0 / max(1, (y > 0).sum()), 1.0 / max(1, (y < 0).sum())) * len(y)
    w = svm(z, y, cost)
    for _ in range(2):  # the harmless sentences of toxic documents leave the positives
        margin = z @ w[:-1]
        order = np.lexsort((-margin, of))
        rank = np.empty(len(of), np.int64)
        starts = np.r_[0, np.flatnonzero(np.diff(of[order])) + 1]
        rank[order] = np.arange(len(of)) - np.repeat(starts, np.diff(np.r_[starts, len(of)]))
        use = (y < 0) | (rank < TOP)
        cost = np.where(y > 0, 1.0 / max(1, (use & (y > 0)).sum()), 1.0 / max(1, (use & (y < 0)).sum())) * use.sum()
        w = svm(z[use], y[use], cost[use])
    table = np.zeros(size, np.float32)
    table[used] = phi @ (root @ w[:-1])
    nothing = np.zeros(1, np.uint32)
    table[_hashed(nothing, nothing, nothing, nothing)] = 0  # blanks alone say nothing

    # Levels: from the windows of the training documents; then the documents' own regression.
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    hit = np.array([responses(padded(*decoded(np.frombuffer(f" {m} ".encode(), np.uint8), np.array([0, len(m.encode()) + 2])))[0], table).max() for m in marks])
    top = np.median(np.sort(hit)[-max(8, len(hit) // 4) :])
    model = Model(table, levels=top * np.array([0.35, 0.5, 0.65, 0.8]))
    x = _design(counts(raw, offsets, model))
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-6
    model.coef = logistic((x - model.mean) / model.scale, labels.astype(float))
    return model


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, label: str = "toxic") -> Model:
    """Fit on about `most` documents of each label."""
    rows = labels.filter(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    picked = bounded_sample(rows, "label", most)
    # The sample of ids is bounded, so it may be broadcast; the texts then need no shuffle.
    got = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").orderBy("doc_id").collect()
    return fit([r.text or "" for r in got], np.array([r.label for r in got], dtype=np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = flat(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(scores(raw, offsets, model), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) mod 3 is not 1, score all: doc_id, held_out, score, predicted."""
    model = train(docs, labels.filter(crc_mod(F.col("doc_id"), 3) != 1), most)
    return score(docs, model).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
