"""Best-fit packing (operator 1): sum-of-squares packing of tokenised documents into fixed-length sequences.

A document's ids (then id 0) form a piece, or pieces of the capacity if it is longer. Each piece goes where the sum,
over residual gaps, of the squared count of open bins with that gap becomes smallest; opening a bin is one of the
choices. That keeps open bins of every gap in stock and leaves few bins unfilled. Pieces are taken in falling order of length.

Packing is sequential, so it is done in shards of about SHARD pieces, drawn by a hash of the piece and of its row's place, so
that copies and repeated rows are dealt like others, all in parallel. What a shard can't close well is packed again: the bins that lack more
than SLACK tokens are dissolved, and their pieces, a small part of all, dealt to fewer shards of the same size, and the
leftovers of those once more. A round that would not shrink the leftovers is the last.

Words repeat, so a worker tokenises only words it has not seen lately: the vocabulary drops white space, and no merge
crosses it, so a text's ids are its words' ids one after another. Special tokens that stand in a text are taken as such, as the
library does by default. Both hold for the pipeline that USUAL describes; with any other file the library encodes whole texts.

Edge cases: null and empty texts are one piece that holds only id 0; texts of any length are tokenised whole; repeated rows
and null ids are packed like any others; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, small_batches

CAPACITY = 2048
#: Pieces that one task packs.
SHARD = 20_000
#: A bin that lacks more tokens than this after a round is packed again.
SLACK = 0
#: Words that a worker remembers, and the longest that it does.
MEMO, LONGEST = 900_000, 64
#: Fixed value: the normaliser and the cut of the pipeline whose words can be taken one by one.
USUAL = (
    ["NFC", "Replace", "Lowercase"],
    ["Split", "ByteLevel"],
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
)

# Fixed value: the characters with the Unicode property White_Space.
_SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
#: Fixed value: the vocabulary's own cut of a word, for lower-case printable ASCII.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_NOT_SPACE = regex.compile("[\x1c-\x1f]")


def split_words(text: str) -> list[str]:
    """text at its white space; str.split also cuts at the four separators that have no such property."""
    return [w for w in _SPACE.split(text) if w] if _NOT_SPACE.search(text) else text.split()


class WordIds(dict):
    """Word -> its ids as little-endian uint32 bytes.

    Holds MEMO words at most: two generations, of which the older goes when the younger is full, so that frequent
    words stay. A word goes through the steps of the library's pipeline one by one (normaliser, cut, merges), and the
    parts it is cut into are remembered too; for printable ASCII the first two are lower case and a pattern.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word, self.special = _usual(self.tokenizer.to_str())
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.old: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        if self.by_word:
            self.model, self.normalise = self.tokenizer.model, self.tokenizer.normalizer.normalize_str
            self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(part)])
            if len(part) <= LONGEST:
                if len(self.parts) >= MEMO // 2:
                    self.parts.clear()
                self.parts[part] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isascii() and word.isprintable():
                low = word.lower()
                ids = self._part(low) if low.isalpha() else b"".join(map(self._part, _PARTS.findall(low)))
            else:
                ids = b"".join([self._part(x) for x, _ in self.cut(self.normalise(word))])
        if len(word) <= LONGEST:
            if len(self) >= MEMO // 2:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids of a text."""
        text = text or ""
        if not self.by_word:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.specials is None or not self.specials.search(text):
            return b"".join(map(self.__getitem__, split_words(text)))
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [*map(self.__getitem__, split_words(text[at : m.start()])), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, *map(self.__getitem__, split_words(text[at:]))])


def _usual(described: str) -> tuple[bool, dict[str, int]]:
    """Whether a tokenizer's words can be taken one by one, and its added tokens."""
    t = json.loads(described)
    steps = lambda part, name: [x["type"] for x in (t[part] or {}).get(name, [])]
    added = t["added_tokens"]
    by_word = steps("normalizer", "normalizers") == USUAL[0] and steps("pre_tokenizer", "pretokenizers") == USUAL[1]
    by_word = by_word and t["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": USUAL[2]}
    by_word = by_word and not any(x[f] for x in added for f in ("single_word", "lstrip", "rstrip", "normalized"))
    return by_word, {x["content"]: x["id"] for x in added}


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenise(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids themselves if asked for."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _word_ids(path), np.array([end_id], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            out: list[list] = [[] for _ in range(5 + with_ids)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = words.encode(text.as_py()) + end
                for k, a in enumerate(range(0, len(raw), step)):
                    part = raw[a : a + step]
                    row = [doc_id, k, a // 4, len(part) // 4, zlib.crc32(part)]
                    for values, v in zip(out, row + [np.frombuffer(part, "<u4").astype(np.int32)] * with_ids, strict=True):
                        values.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=False)], names[: len(out)])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each size, taken in falling order of size.

    open_[h] counts the bins filled to h. Moving a bin from level h to h + s changes the sum of squares by
    2 (open_[h + s] - open_[h]) + 2, one less at either end (a new bin, a full bin), which the entries +1/2 at level
    0 and -1/2 at capacity express. Of equal choices the fullest bin is taken.
    """
    open_ = np.zeros(capacity + 1, dtype=np.float64)
    cost = np.full(capacity + 1, np.inf)  # -open_ where a bin can be taken, else infinite
    open_[0], cost[0], open_[capacity] = 0.5, -0.5, -0.5
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    n = 0
    for k in np.argsort(-sizes, kind="stable"):
        s = int(sizes[k])
        change = open_[s:] + cost[: capacity + 1 - s]
        h = len(change) - 1 - int(np.argmin(change[::-1]))
        if h == 0:
            b, n = n, n + 1
        else:
            b = bins[h].pop()
            open_[h] -= 1
            cost[h] = -open_[h] if open_[h] else np.inf
        out[k] = b
        to = h + s
        if to < capacity:
            bins[to].append(b)
            open_[to] += 1
            cost[to] = -open_[to]
    return out


def _pack_shard(rows: pd.DataFrame, capacity: int, prefix: int) -> pd.DataFrame:
    rows = rows.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
    sizes = rows["length"].to_numpy(dtype=np.int64)
    bins = sum_of_squares(sizes, capacity)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(sizes[order])
    first = np.r_[True, bins[order][1:] != bins[order][:-1]]
    base = np.repeat((ends - sizes[order])[first], np.diff(np.r_[np.flatnonzero(first), len(order)]))
    offset = np.empty(len(sizes), dtype=np.int64)
    offset[order] = ends - sizes[order] - base
    fill = np.bincount(bins, weights=sizes).astype(np.int64)
    return rows.assign(
        sequence_id=(prefix << 56) + (rows["shard"].to_numpy(dtype=np.int64) << 24) + bins, offset=offset, gap=capacity - fill[bins]
    )


def _shard_packer(capacity: int, prefix: int):
    return lambda rows: _pack_shard(rows, capacity, prefix)


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, slack: int = SLACK, rounds: int = 3) -> DataFrame:
    """pieces with sequence_id and offset: in shards, then the pieces of badly filled bins again, over rounds."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, shard long, sequence_id long, offset long, gap long"
    left, n, done = materialise(pieces, "pieces"), None, None
    for k in range(rounds):
        m = left.count()
        shards = max(1, -(-m // shard))
        if n is not None and (m == 0 or 2 * m > n):  # nothing left, or the round before did not close enough bins
            break
        # The place in the written table is the same whenever a task is repeated.
        key = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id(), F.lit(k)), F.lit(shards))
        rows = left.select("doc_id", "piece", "start", "length", "ids_crc32", key.alias("shard"))
        packed = rows.groupBy("shard").applyInPandas(_shard_packer(capacity, k), schema)
        packed = materialise(packed, "packed")
        last = shards == 1 or k == rounds - 1
        closed = packed if last else packed.filter(F.col("gap") <= slack)
        if last:
            done, left = closed if done is None else done.unionByName(closed), None
            break
        done = closed if done is None else done.unionByName(closed)
        left, n = packed.filter(F.col("gap") > slack), m
    if left is not None and left.schema.fieldNames()[-1] == "gap":
        done = done.unionByName(left)
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise and pack every document."""
    return pack(tokenise(docs, path, capacity), capacity)
