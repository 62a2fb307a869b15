"""Suffix-array dedup (operator 10): long repeated substrings, by a logarithmic index family of sparse suffix arrays.

A byte goes if some LENGTH-byte string that covers it also starts earlier (smaller document, or earlier in the same).

Sparse suffixes. Every window of LENGTH bytes holds LENGTH - K + 1 grams of K bytes; the window's anchor is the gram of
smallest fingerprint, the leftmost of equals. Equal windows have equal anchors at equal offsets, so only suffixes that
start at anchors, about one in 33, need to be indexed. The windows that share one anchor are consecutive: a *region*.

1. Each task turns its texts into entries (fingerprint of the gram, fingerprint of the whole region, document, place)
   and folds equal regions at once, keeping the earliest: a passage in a third of all texts leaves a task once.
2. Entries are dealt to shards by the gram, where equal regions are folded again. What is left are distinct regions;
   those whose gram occurs in several may still share windows and are reported for checking.
3. Texts meet the reports (dealt by a hash of id and text, in blocks of bounded size). A text without reports to check
   is finished. For the others the bytes of such regions go to shards of the gram, and there to the index family:
   the regions of some blocks are a batch, whose windows get a suffix array (the sparse suffixes in lexicographic order of
   their bytes); it is merge-scanned with the levels that exist, where neighbours with a common prefix of LENGTH bytes
   are matches of which the earlier stays; and levels of equal size merge geometrically, so that each window takes part in
   a logarithmic number of merges. A merge of two sorted levels is linear (timsort joins two runs).
4. The texts that waited get their windows from 3 and are finished.

Hot grams. A counting pass takes a histogram of the grams' hashes over all texts. Hashes of more than a fixed number of entries
above the mean (HOT) would gather in one shard; each window of their regions is an entry of its own, dealt by the
window's content and folded by its fingerprint in tasks first. So no gram has more than that many regions in 3.

Fingerprints are 64 bits, of a region as a whole (or of a hot gram's window); two different ones with one fingerprint are
the only way to go wrong, at odds of n^2 / 2^65 for n regions of one gram's 32 bits. What 3 compares, it compares byte by byte.

Edge cases: null and empty texts have no bytes (and the empty digest's hash); texts under LENGTH bytes keep all bytes;
rows that repeat both doc_id and text count as one document, get the same result and are dealt to one block; of one id's different texts the one
of smaller sha256 is earlier; a null id is later than all others (2^63 - 1 is taken for null); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.storage import discard, sweep
from tessera.llm.common import flat, materialise, mix64, small_batches

LENGTH = 100
K = 36
#: Bytes of text handled at a time; positions within must fit 20 bits.
BLOCK = 1 << 19
#: Bytes of entries that a task gathers before it folds them and sends them off.
GATHER = 40 << 20
#: Bytes of text for each shard of entries, and for each block of texts.
SHARD_BYTES, BLOCK_BYTES = 16 << 20, 6 << 20
#: Entries above the mean of all hashes that make a hash of grams hot; and about how many entries a hash has.
HOT, MEAN = 2048, 256
#: Windows that are put into one index family together, and in each of its batches.
CHUNK, BATCH = 1 << 17, 1 << 14
#: Hashes of grams whose counts travel together.
RANGE = 1 << 12
NULL_ID = np.iinfo(np.int64).max

_B = 0x9E3779B97F4A7C15
_I = pow(_B, -1, 1 << 64)
_MASK = np.uint64((1 << 20) - 1)

ENTRY = np.dtype([("region", "<u8"), ("gram", "<u4"), ("shard", "<u4"), ("doc", "<i8"), ("sha", "<u8"), ("at", "<i8"), ("n", "u1")])
#: A report: n windows from `at` on are covered (check = 0), or are to be compared with others of the gram (check = 1).
REPORT = np.dtype([("doc", "<i8"), ("sha", "<u8"), ("at", "<i8"), ("n", "u1"), ("gram", "<u4"), ("shard", "<u4"), ("check", "u1")])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], m = 1, 1
    while m < n:
        k = min(m, n - m)
        out[m : m + k] = out[:k] * np.uint64(pow(base, m, 1 << 64))
        m += k
    return out


_tables: dict[str, np.ndarray] = {}


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables["p"]) < n:
        _tables["p"], _tables["i"] = _powers(_B, n), _powers(_I, n)
    return _tables["p"], _tables["i"]


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if w > span else x


def regions(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, k: int = K) -> dict[str, np.ndarray]:
    """The regions of the texts raw[starts:ends], of at most 2^20 bytes together.

    text: index; at: first window's place in raw; n: windows; off: from `at` to the anchor; gram, region: fingerprints.
    """
    none = {f: np.zeros(0, np.int64) for f in ("text", "at", "n", "off")} | {f: np.zeros(0, np.uint64) for f in ("gram", "region")}
    if len(raw) < length:
        return none
    p, inv = _table(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[: len(raw)], out=sums[1:])
    grams = mix64((sums[k:] - sums[:-k]) * inv[: len(raw) - k + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min((grams & ~_MASK) | place, length - k + 1)
    count = np.maximum(ends - starts - length + 1, 0)
    if not count.sum():
        return none
    text = np.repeat(np.arange(len(starts)), count)
    first = np.cumsum(count) - count
    window = np.arange(count.sum()) - np.repeat(first, count) + np.repeat(starts, count)
    anchor = (least[window] & _MASK).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
    head = np.flatnonzero(new)
    n = np.diff(np.r_[head, len(window)])
    at, a = window[head], anchor[head]
    body = (sums[at + n - 1 + length] - sums[at]) * inv[at]
    shape = (n.astype(np.uint64) << np.uint64(32)) ^ (a - at).astype(np.uint64)
    return {"text": text[head], "at": at, "n": n, "off": a - at, "gram": grams[a], "region": mix64(mix64(body) + shape)}


def text_regions(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, dict[str, np.ndarray], np.ndarray]]:
    """Blocks of texts: first text, the block's place in raw, its regions, its bytes. Long texts come in overlapping cuts."""
    n, i = len(offsets) - 1, 0
    while i < n:
        a = int(offsets[i])
        if offsets[i + 1] - a > BLOCK:
            end = int(offsets[i + 1])
            for lo in range(a, end, BLOCK):
                hi = min(end, lo + BLOCK + LENGTH - 1)
                yield i, lo, regions(raw[lo:hi], np.array([0]), np.array([hi - lo])), raw[lo:hi]
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, a + BLOCK, side="right")) - 1)
        part = raw[a : int(offsets[j])]
        yield i, a, regions(part, offsets[i:j] - a, offsets[i + 1 : j + 1] - a), part
        i = j


def _entries(docs: np.ndarray, shas: np.ndarray, raw: np.ndarray, offsets: np.ndarray, hot: np.ndarray, n_buckets: int, n_shards: int) -> Iterator[np.ndarray]:
    """The regions of the texts as entries; hot: the hashes of grams whose windows are entries."""
    for i, base, r, part in text_regions(raw, offsets):
        if not len(r["at"]):
            continue
        if len(hot):
            is_hot = np.isin(_bucket(r["gram"], n_buckets), hot)
            if is_hot.any():
                yield _windows(docs, shas, offsets, i, base, {f: v[is_hot] for f, v in r.items()}, part, n_shards)
                r = {f: v[~is_hot] for f, v in r.items()}
        e = np.empty(len(r["at"]), ENTRY)
        t = r["text"] + i
        e["region"], e["gram"], e["shard"], e["n"] = r["region"], _short(r["gram"]), _shard(r["gram"], n_shards), r["n"]
        e["doc"], e["sha"], e["at"] = docs[t], shas[t], r["at"] + base - offsets[t]
        yield e


def _short(gram: np.ndarray) -> np.ndarray:
    """The 32 bits that group the grams of a shard; two that agree by chance are only compared in vain."""
    return (gram >> np.uint64(32)).astype(np.uint32)


def _shard(gram: np.ndarray, n_shards: int) -> np.ndarray:
    """By the other 32 bits, so that chance agreements stay as rare in a larger table, which has more shards."""
    return gram.astype(np.uint32) % np.uint32(n_shards)


def _bucket(gram: np.ndarray, n_buckets: int) -> np.ndarray:
    return (_short(gram) % np.uint32(n_buckets)).astype(np.int64)


def _windows(docs, shas, offsets, i, base, r, part, n_shards) -> np.ndarray:
    """Each window of the regions as an entry, dealt by its own content."""
    p, inv = _table(len(part) + 1)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * p[: len(part)], out=sums[1:])
    first = np.cumsum(r["n"]) - r["n"]
    at = np.arange(r["n"].sum()) - np.repeat(first, r["n"]) + np.repeat(r["at"], r["n"])
    t = np.repeat(r["text"], r["n"]) + i
    e = np.zeros(len(at), ENTRY)
    e["region"] = mix64(mix64((sums[at + LENGTH] - sums[at]) * inv[at]) + np.uint64(0x5BD1E995))
    e["gram"], e["shard"], e["n"], e["doc"], e["sha"], e["at"] = _short(e["region"]), _shard(e["region"], n_shards), 1, docs[t], shas[t], at + base - offsets[t]
    return e


def fold(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted or unsorted entries: the earliest of each region in order of region, and the later ones."""
    e = e[np.argsort(e["region"], kind="stable")]
    same = np.r_[False, e["region"][1:] == e["region"][:-1]] if len(e) else np.zeros(0, bool)
    if not same.any():
        return e, e[:0]
    tied = same.copy()
    tied[:-1] |= same[1:]
    at = np.flatnonzero(tied)
    t = e[at]
    order = np.lexsort((t["at"], t["sha"], t["doc"], t["region"]))
    t = t[order]
    e[at] = t
    first = np.r_[True, t["region"][1:] != t["region"][:-1]]
    # A repeated row's entry is the same entry.
    again = np.r_[False, (t["doc"][1:] == t["doc"][:-1]) & (t["sha"][1:] == t["sha"][:-1]) & (t["at"][1:] == t["at"][:-1])] & ~first
    keep = ~tied
    keep[at[first]] = True
    return e[keep], t[~first & ~again]


class IndexFamily:
    """Suffix arrays of windows, in levels of geometrically growing size; no two levels hold about as much.

    A level: the distinct windows in lexicographic order, as (keys, ranks): LENGTH bytes, and the earliest place of all
    that were met. `covered` gathers the ranks of windows that an earlier one equals.
    """

    def __init__(self):
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.covered: list[np.ndarray] = []

    def add(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """keys: (n, LENGTH) bytes of a batch's windows."""
        size, level = max(1, len(keys)).bit_length(), self._scan(keys, ranks)
        while size in self.levels:  # merge-scan with the level of equal size, which moves both one level up
            level = self._joined(level, self.levels.pop(size))
            size += 1
        self.levels[size] = level

    def finish(self) -> np.ndarray:
        """The ranks of all windows that an earlier one equals."""
        level = None
        for size in sorted(self.levels):
            level = self.levels[size] if level is None else self._joined(level, self.levels[size])
        return np.concatenate(self.covered) if self.covered else np.zeros(0, np.int64)

    def _joined(self, x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return self._scan(np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]]))

    def _scan(self, keys: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return keys, ranks
        order = np.argsort(np.ascontiguousarray(keys).view(f"V{LENGTH}").ravel(), kind="stable")
        keys, ranks = keys[order], ranks[order]
        match = common_prefix(keys[:-1], keys[1:]) >= LENGTH
        head = np.flatnonzero(np.r_[True, ~match])
        first = np.minimum.reduceat(ranks, head)
        self.covered.append(ranks[ranks != np.repeat(first, np.diff(np.r_[head, len(ranks)]))])
        return keys[head], first


def common_prefix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The length of the common prefix of each row of x and y."""
    differ = x != y
    return np.where(differ.any(1), differ.argmax(1), x.shape[1])


def _report(e: np.ndarray, check: int) -> np.ndarray:
    out = np.empty(len(e), REPORT)
    for f in ("doc", "sha", "at", "n", "gram", "shard"):
        out[f] = e[f]
    out["check"] = check
    return out


def _block_of(doc: np.ndarray, sha: np.ndarray, n: int) -> np.ndarray:
    """_block_sql: xxhash64(doc) as Spark computes it for a bigint, mixed with the upper 60 bits of the sha256."""
    p1, p2, p3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    p4, p5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)

    def rotl(x, r):
        return (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    h = (p5 + np.uint64(42 + 8)) ^ (rotl(doc.astype(np.int64).view(np.uint64) * p2, 31) * p1)
    h = rotl(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return (h ^ (h >> np.uint64(32)) ^ (sha.astype(np.uint64) >> np.uint64(4))).view(np.int64) % n


def pack(rows: np.ndarray) -> bytes:
    """Records field by field, 8-byte places in two halves, so that what repeats stands together and compresses."""
    out = [np.int64(len(rows)).tobytes()]
    for f in rows.dtype.names:
        v = np.ascontiguousarray(rows[f])
        out += [v.astype("<u4").tobytes(), (v >> 32).astype("<u4").tobytes()] if f == "at" else [v.tobytes()]
    return b"".join(out)


def unpack(data: bytes, kind: np.dtype) -> tuple[np.ndarray, bytes]:
    """The records, and what follows them."""
    n, at = int(np.frombuffer(data, "<i8", 1)[0]), 8
    rows = np.empty(n, kind)
    for f in kind.names:
        if f == "at":
            rows[f] = np.frombuffer(data, "<u4", n, at) | (np.frombuffer(data, "<u4", n, at + 4 * n).astype(np.int64) << 32)
            at += 8 * n
        else:
            rows[f] = np.frombuffer(data, kind[f], n, at)
            at += kind[f].itemsize * n
    return rows, data[at:]


def _unpack_all(column, kind: np.dtype) -> np.ndarray:
    parts = [unpack(x, kind)[0] for x in column.to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _dealt(rows: np.ndarray, to: np.ndarray, kind: str) -> pa.Table:
    """One row for each target: the target and its records, packed."""
    order = np.argsort(to, kind="stable")
    rows, to = rows[order], to[order]
    cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, np.int64)
    parts = [pack(rows[a:b]) for a, b in zip(cut, [*cut[1:], len(to)], strict=False)]
    return pa.table({kind: pa.array(to[cut], pa.int64()), "records": pa.array(parts, pa.binary())})


def _texts(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, the first 8 bytes of each text's sha256 as a number, the bytes, the offsets; of columns doc_id, sha, text."""
    ids = np.array([NULL_ID if x is None else x for x in batch.column(0).to_pylist()], dtype=np.int64)
    shas = np.array([int(x[:16], 16) for x in batch.column(1).to_pylist()], dtype=np.uint64)
    raw, offsets = flat(batch.column(2))
    return ids, shas, raw, offsets


_COUNT = np.dtype([("bucket", "<u4"), ("n", "<u4")])


def _hot_grams(texts: DataFrame, n_buckets: int) -> np.ndarray:
    """The hashes of grams with over HOT entries more than twice the mean; no more of them than the table has entries / HOT."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            pairs = np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64)  # equal regions leave a task once
            found, times = np.unique((pairs >> np.uint64(32)).astype(np.int64) % n_buckets, return_counts=True)
            rows = np.empty(len(found), _COUNT)
            rows["bucket"], rows["n"] = found, times
            lot = found // RANGE
            cut = np.flatnonzero(np.r_[True, lot[1:] != lot[:-1]]) if len(lot) else np.zeros(0, np.int64)
            packed = [rows[a:b].tobytes() for a, b in zip(cut, [*cut[1:], len(rows)], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(lot[cut], pa.int64()), pa.array(packed, pa.binary())], ["lot", "counts"])

        for batch in batches:
            raw, offsets = flat(batch.column(0))
            held += [r["gram"] & ~np.uint64(0xFFFFFFFF) | r["region"] >> np.uint64(32) for _, _, r, _ in text_regions(raw, offsets)]
            if sum(map(len, held)) > 1 << 20:
                yield from flush()
                held = []
        yield from flush()

    def total(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table.column(1).to_pylist()), _COUNT)
        base = table.column(0)[0].as_py() * RANGE
        n = np.bincount(rows["bucket"] - base, weights=rows["n"], minlength=RANGE).astype(np.int64)
        many = np.flatnonzero(n > HOT)  # and the lot's sum, as bucket -1
        return pa.table({"bucket": pa.array(np.r_[-1, many + base], pa.int64()), "n": pa.array(np.r_[n.sum(), n[many]], pa.int64())})

    counts = texts.select("text").mapInArrow(count, "lot long, counts binary").groupBy("lot").applyInArrow(total, "bucket long, n long")
    counts = materialise(counts, "grams")
    mean = (counts.filter("bucket < 0").agg(F.sum("n")).first()[0] or 0) / n_buckets
    hot = [r.bucket for r in counts.filter((F.col("bucket") >= 0) & (F.col("n") > 2 * mean + HOT)).collect()]
    discard(counts)
    return np.array(sorted(hot), dtype=np.int64)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.sha2(text, 256).alias("sha"), text.alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards, n_blocks = max(4, size // SHARD_BYTES), max(4, size // BLOCK_BYTES)
    n_buckets = min(1 << 24, max(64, size // 33 // MEAN))
    hot = _hot_grams(base, n_buckets)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush():
            kept, later = fold(np.concatenate(held)) if held else (np.zeros(0, ENTRY), np.zeros(0, ENTRY))
            to = kept["shard"].astype(np.int64)
            order = np.lexsort((kept["at"], kept["doc"]))  # by place, so that the places compress
            yield from _dealt(kept[order], to[order], "shard").to_batches()
            # What the task itself found covered passes through any shard.
            if len(later):
                yield from _dealt(later, -1 - np.arange(len(later)) * n_shards // len(later), "shard").to_batches()

        for batch in batches:
            ids, shas, raw, offsets = _texts(batch)
            for e in _entries(ids, shas, raw, offsets, hot, n_buckets, n_shards):
                held.append(e)
                size += e.nbytes
                if size >= GATHER:
                    yield from flush()
                    held, size = [], 0
        yield from flush()

    def merge(table: pa.Table) -> pa.Table:
        arrived = [unpack(x, ENTRY)[0] for x in table.column(1).to_pylist()]
        if table.num_rows and table.column(0)[0].as_py() < 0:
            out = _report(np.concatenate(arrived), 0)
        else:
            rest, covered = fold(np.concatenate(arrived))
            order = np.argsort(rest["gram"], kind="stable")
            g = rest["gram"][order]
            twin = np.zeros(len(g), bool)
            if len(g):
                equal = g[1:] == g[:-1]
                twin[1:] |= equal
                twin[:-1] |= equal
            out = np.concatenate([_report(covered, 0), _report(rest[order[twin]], 1)])
        return _dealt(out, _block_of(out["doc"], out["sha"], n_blocks), "block")

    entries = base.mapInArrow(index, "shard long, records binary")
    reports = materialise(entries.groupBy("shard").applyInArrow(merge, "block long, records binary"), "reports")
    sweep(spark)

    # Texts meet the reports of their block. kind 0: finished; 1: waits; 2: regions to compare.
    schema = "kind int, block long, doc_id long, sha string, text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, shard long, records binary"

    placed = base.select(F.expr(_block_sql(n_blocks)).alias("block"), "doc_id", "sha", "text")
    met = placed.groupBy("block").cogroup(reports.groupBy("block")).applyInArrow(_meet, schema)
    met = materialise(met, "met")
    discard(reports)
    sweep(spark)

    compared = met.filter("kind = 2").select("shard", "records").groupBy("shard").applyInArrow(_comparer(n_blocks), "block long, records binary")
    waiting = met.filter("kind = 1").select("block", "doc_id", "sha", "text", "records")
    final = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    late = waiting.groupBy("block").cogroup(compared.groupBy("block")).applyInArrow(_finish_late, final)
    return met.filter("kind = 0").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").unionByName(late)


def _slices(rows: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], tuple[int, int]]]:
    """Reports in order of their document, and each document's slice."""
    rows = rows[np.lexsort((rows["at"], rows["sha"], rows["doc"]))]
    cut = np.flatnonzero(np.r_[True, (rows["doc"][1:] != rows["doc"][:-1]) | (rows["sha"][1:] != rows["sha"][:-1])]) if len(rows) else []
    keys = [(int(rows["doc"][i]), int(rows["sha"][i])) for i in cut]
    return rows, dict(zip(keys, zip(cut, [*cut[1:], len(rows)], strict=True), strict=True))


def _keys(table: pa.Table) -> list[tuple[int, int]]:
    ids, shas = table.column("doc_id").to_pylist(), table.column("sha").to_pylist()
    return [(NULL_ID if i is None else i, int(x[:16], 16)) for i, x in zip(ids, shas, strict=True)]


def _meet(left: pa.Table, right: pa.Table) -> pa.Table:
    rows, of = _slices(_unpack_all(right.column(1), REPORT))
    out: dict[str, list] = {f: [] for f in ("kind", "block", "doc_id", "sha", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "shard", "records")}
    lists = list(out.values())

    def put(*values):
        for held, v in zip(lists, values, strict=True):
            held.append(v)

    again: list[np.ndarray] = []
    blobs: list[bytes] = []
    for key, block, doc_id, sha, text in zip(_keys(left), *(left.column(f) for f in ("block", "doc_id", "sha", "text")), strict=True):
        data = (text.as_py() or "").encode()
        a, b = of.get(key, (0, 0))
        own = rows[a:b]
        check = own["check"] == 1
        if check.any():
            done = own[~check]
            put(1, block.as_py(), doc_id.as_py(), sha.as_py(), text.as_py(), None, None, None, None, None, pack(done))
            again.append(own[check])
            blobs += [data[x : x + n + LENGTH - 1] for x, n in zip(own["at"][check].tolist(), own["n"][check].tolist(), strict=True)]
        else:
            put(0, None, doc_id.as_py(), None, None, *_result(data, own["at"], own["n"]), None, None)
    if again:
        e = np.concatenate(again)
        shard = e["shard"].astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0])
        for x, y in zip(cut, [*cut[1:], len(order)], strict=True):
            to = order[x:y]
            put(2, *[None] * 8, int(shard[to[0]]), pack(e[to]) + b"".join(blobs[i] for i in to))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.table({f: pa.array(v, k) for (f, v), k in zip(out.items(), kinds, strict=True)})


def _keys_of(data: list[bytes], n: np.ndarray) -> np.ndarray:
    """The windows of regions with n windows each, as rows of LENGTH bytes."""
    raw = np.frombuffer(b"".join(data), np.uint8)
    length = n + LENGTH - 1
    starts = np.cumsum(length) - length
    first = np.cumsum(n) - n
    at = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(starts, n)
    return np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[at]


def compare(e: np.ndarray, data: list[bytes], batch: np.ndarray | None = None) -> np.ndarray:
    """Reports of the windows, among regions of equal grams, that an earlier region holds too.

    batch: the batch that each region came in. Grams are taken together up to CHUNK windows, and have one family.
    """
    batch = np.zeros(len(e), np.int64) if batch is None else batch
    order = np.lexsort((e["at"], e["sha"], e["doc"], e["gram"]))
    t = e[order]
    again = np.r_[False, np.all([t[f][1:] == t[f][:-1] for f in ("gram", "doc", "sha", "at")], axis=0)] if len(t) else np.zeros(0, bool)
    order = order[~again]  # repeated rows report the same region
    gram, n = e["gram"][order], e["n"][order].astype(np.int64)
    ends = np.flatnonzero(np.r_[gram[1:] != gram[:-1], True]) + 1 if len(gram) else np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(n)])
    out, lo = [], 0
    for hi in ends.tolist():
        if total[hi] - total[lo] < CHUNK and hi < len(order):
            continue
        r = order[lo:hi]
        r = r[np.lexsort((e["at"][r], e["sha"][r], e["doc"][r]))]  # a window's rank is its place in this order
        m = e["n"][r].astype(np.int64)
        first = np.concatenate([[0], np.cumsum(m)])
        family = IndexFamily()
        arrived = np.argsort(batch[r], kind="stable")
        lot = np.cumsum(m[arrived]) // BATCH
        for b in np.unique(lot).tolist():  # what arrived together, in batches of about BATCH windows
            i = arrived[lot == b]
            ranks = np.arange(m[i].sum()) + np.repeat(first[i] - (np.cumsum(m[i]) - m[i]), m[i])
            family.add(_keys_of([data[k] for k in r[i]], m[i]), ranks)
        gone = np.zeros(first[-1] + 1, bool)
        gone[family.finish()] = True
        owner = np.repeat(np.arange(len(r)), m)
        edge = np.r_[True, owner[1:] != owner[:-1], True]
        on = gone[:-1]
        start = np.flatnonzero(on & (edge[:-1] | np.r_[True, ~on[:-1]]))
        stop = np.flatnonzero(on & (edge[1:] | np.r_[~on[1:], True])) + 1
        rows = np.empty(len(start), REPORT)
        own = r[owner[start]]
        for f in ("doc", "sha", "gram", "shard"):
            rows[f] = e[f][own]
        rows["at"], rows["n"], rows["check"] = e["at"][own] + start - first[owner[start]], stop - start, 0
        out.append(rows)
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, REPORT)


def _comparer(n_blocks: int):
    def run(table: pa.Table) -> pa.Table:
        found, data = [], []
        for x in table.column(1).to_pylist():
            e, blob = unpack(x, REPORT)
            ends = np.cumsum(e["n"].astype(np.int64) + LENGTH - 1).tolist()
            data += [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            found.append(e)
        batch = np.repeat(np.arange(len(found)), [len(e) for e in found])
        out = compare(np.concatenate(found), data, batch) if found else np.zeros(0, REPORT)
        return _dealt(out, _block_of(out["doc"], out["sha"], n_blocks), "block")

    return run


def _finish_late(left: pa.Table, right: pa.Table) -> pa.Table:
    """The rows of texts that waited, with the reports of both rounds."""
    rows, of = _slices(_unpack_all(right.column(1), REPORT))
    out = []
    for key, text, before in zip(_keys(left), left.column("text"), left.column("records"), strict=True):
        a, b = of.get(key, (0, 0))
        own = np.concatenate([unpack(before.as_py(), REPORT)[0], rows[a:b]])
        out.append(_result((text.as_py() or "").encode(), own["at"], own["n"]))
    n_bytes, n_removed, n_spans, sha = zip(*out, strict=True) if out else ([], [], [], [])
    return pa.table({
        "doc_id": left.column("doc_id").combine_chunks().cast(pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
        "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string()),
    })


def _block_sql(n: int) -> str:
    return f"pmod(xxhash64(coalesce(doc_id, {NULL_ID}L)) ^ cast(conv(substring(sha, 1, 15), 16, 10) as bigint), {n}L)"


def cover(n_bytes: int, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs [start, end) of bytes that the windows cover."""
    if not len(at):
        return at, at
    change = np.zeros(n_bytes + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, np.minimum(at + n - 1 + LENGTH, n_bytes), -1)
    on = np.cumsum(change[:-1]) > 0
    edge = np.diff(np.r_[False, on, False].astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _result(data: bytes, at: np.ndarray, n: np.ndarray) -> tuple[int, int, int, str]:
    a, b = cover(len(data), at, n)
    if not len(a):
        return len(data), 0, 0, hashlib.sha256(data).hexdigest()
    rest = hashlib.sha256()
    for x, y in zip(np.r_[0, b].tolist(), np.r_[a, len(data)].tolist(), strict=True):
        rest.update(data[x:y])
    return len(data), int((b - a).sum()), len(a), rest.hexdigest()
