"""Byte-level BPE (operator 3): encoding and decoding as a monoid tree reduction.

Two levels, each a monoid whose elements are encoded spans and whose product joins two neighbours.

* Text -> pre-tokens. A text is halved recursively down to LEAF characters, each leaf split by the pattern, and
  neighbours joined by splitting a growing window around the cut anew. The pattern looks at most two characters past
  the end of a match, so a match that ends MARGIN characters before a span's end is final, and the split of any
  suffix that starts at a match is the suffix of the split. The window has settled once one of its final matches
  starts where a match of the right span starts.
* Pre-token -> tokens. A long pre-token is halved recursively, leaves are merged by rank, and neighbours are joined
  by encoding a growing window of tokens around the cut anew. It has settled when the window's first and last token
  come out unchanged: merges by lowest rank never cross a boundary between two tokens if they do not cross it when
  those two are encoded alone, so a sequence is the encoding exactly if each adjacent pair is. All pairs outside the
  window were adjacent before, and all inside stand in an encoding.

Pre-tokens repeat, so each worker memoises them in a bounded table. Decoding concatenates up a balanced tree.

Edge cases: null and empty texts have no tokens (the empty digest's hash); repeated rows are encoded one by one; text
that holds the name of a special token is ordinary text; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import WS, small_batches

LEAF = 8192
MARGIN = 3
#: Bytes of a pre-token below which merges are done directly.
PIECE_LEAF = 48
#: Pre-tokens that a worker remembers.
MEMO = 700_000
#: Larger than any rank.
NEVER = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file; every worker reads its own copy of the installed vocabulary."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_leaf(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Merge the adjacent pair of lowest rank, leftmost first, until none has a rank."""
    parts = [data[i : i + 1] for i in range(len(data))]
    rank = ranks.get
    pairs = [rank(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
    while pairs:
        best = min(pairs)
        if best == NEVER:
            break
        i = pairs.index(best)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], NEVER)
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
    return parts


def merge_window(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """As merge_leaf, with a heap of pairs, for a window of any length: n log n."""
    if len(data) <= 2 * PIECE_LEAF:
        return merge_leaf(data, ranks)
    n = len(data)
    part: list[bytes | None] = [data[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, data[i : i + 2]) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i] if part[i] is not None else n
        if j >= n or part[i] + part[j] != both:
            continue
        part[i], part[j] = both, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for x in (before[i], i):
            if x >= 0 and after[x] < n and (r := ranks.get(pair := part[x] + part[after[x]])) is not None:
                heapq.heappush(heap, (r, x, pair))
    return [t for t in part if t is not None]


def join_tokens(a: list[bytes], b: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """The product of two encodings: the encoding of their concatenated bytes."""
    if not a or not b:
        return a or b
    k = 1
    while True:
        left, right = a[-k:], b[:k]
        whole = b"".join(left) + b"".join(right)
        new = merge_window(whole, ranks)
        if (len(left) == len(a) or new[0] == left[0]) and (len(right) == len(b) or new[-1] == right[-1]):
            return a[: len(a) - len(left)] + new + b[len(right) :]
        if len(left) == len(a) and len(right) == len(b):
            return new
        k *= 2


def _halves(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    if len(data) <= PIECE_LEAF:
        return merge_leaf(data, ranks)
    mid = len(data) // 2
    return join_tokens(_halves(data[:mid], ranks), _halves(data[mid:], ranks), ranks)


def encode_piece(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token."""
    whole = ranks.get(data)
    return [whole] if whole is not None else [ranks[t] for t in _halves(data, ranks)]


def _resplit(text: str, start: int, cut: int, right: list[int], end: int, pattern: regex.Pattern) -> list[int]:
    """Match starts from start, split anew over a growing window until they meet those of the span right of cut."""
    width, known = 64, set(right)
    while True:
        stop = min(end, cut + width)
        out: list[int] = []
        for m in pattern.finditer(text, start, stop):
            if m.start() >= cut and m.start() in known:
                return out + right[_index(right, m.start()) :]
            if m.end() > stop - MARGIN and stop < end:
                break
            out.append(m.start())
        else:
            if stop == end:
                return out
        width *= 2


def _index(values: list[int], x: int) -> int:
    lo, hi = 0, len(values)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if values[mid] < x else (lo, mid)
    return lo


def split_span(text: str, a: int, end: int, pattern: regex.Pattern, leaf: int = LEAF) -> list[int]:
    """Match starts of text[a:end], by halves. Every character of a text is inside some match of the pattern."""
    if end - a <= leaf:
        return [m.start() for m in pattern.finditer(text, a, end)]
    mid = (a + end) // 2
    left, right = split_span(text, a, mid, pattern, leaf), split_span(text, mid, end, pattern, leaf)
    ends = [*left[1:], mid]
    keep = len(left)
    while keep and ends[keep - 1] > mid - MARGIN:
        keep -= 1
    start = ends[keep - 1] if keep else a
    return left[:keep] + _resplit(text, start, mid, right, end, pattern)


def split_text(text: str, pattern: regex.Pattern, leaf: int = LEAF) -> list[str]:
    """The pre-tokens of a text."""
    if len(text) <= leaf:
        return pattern.findall(text)
    starts = split_span(text, 0, len(text), pattern, leaf)
    return [text[i:j] for i, j in zip(starts, [*starts[1:], len(text)], strict=True)]


class _Memo(dict):
    """Pre-token -> its decimal ids joined by spaces.

    Two generations, of which the older goes when the younger is full, so that frequent pre-tokens stay.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.old: dict[str, str] = {}

    def __missing__(self, piece: str) -> str:
        ids = self.old.get(piece)
        if ids is None:
            ids = " ".join(map(str, encode_piece(piece.encode(), self.ranks)))
        if len(self) >= MEMO // 2:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


#: The split that byte-level vocabularies of this family use, with letters tried first (no other branch
#: starts with one), and the same for texts of ASCII alone.
USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REORDERED = r""" ?\p{L}+|'(?:[stmd]|re|ve|ll)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASCII = " ?[A-Za-z]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^{0}A-Za-z0-9]+|[{0}]+(?![^{0}])|[{0}]+".format(WS)


def splitter(pattern: str):
    """Text -> its pre-tokens; for the usual pattern by its faster forms."""
    if pattern != USUAL:
        whole = regex.compile(pattern)
        return lambda text: split_text(text, whole)
    whole, plain = regex.compile(REORDERED), re.compile(ASCII)
    return lambda text: split_text(text, plain if text.isascii() else whole)


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str):
    ranks = load_ranks(path)
    return splitter(pattern), _Memo(ranks), {str(i): t for t, i in ranks.items()}


def concat_tree(parts: list[bytes], leaf: int = 4096) -> bytes:
    """Bytes of token bytes, concatenated pairwise up a balanced tree."""
    level = [b"".join(parts[i : i + leaf]) for i in range(0, len(parts), leaf)] or [b""]
    while len(level) > 1:
        level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0]


def encode_text(text: str | None, path: str, pattern: str) -> list[int]:
    """The ids of a text."""
    split, memo, _ = _codec(path, pattern)
    return [int(x) for p in split(text or "") for x in memo[p].split(" ")]


def decode_ids(ids: list[int], path: str, pattern: str) -> bytes:
    """The bytes of ids."""
    back = _codec(path, pattern)[2]
    return concat_tree([back[str(i)] for i in ids])


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, memo, back = _codec(path, pattern)
        look, token = memo.__getitem__, back.__getitem__
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                joined = " ".join(map(look, split(text)))
                ids = joined.split(" ") if joined else []
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(joined.encode()).hexdigest())
                text_hash.append(hashlib.sha256(concat_tree(list(map(token, ids)))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
