"""N-gram Jaccard join (operator 9): an exact similarity join of shingle sets over a token-group matrix.

Sets. A document's set is its distinct SHINGLE-word shingles, as 64-bit fingerprints (both numbers are parameters). Documents with equal sets are one
class; only classes are joined, and copies are never expanded.

Coarse tokens. Two sets that link differ in at most k = (100 - PERCENT) / (100 + PERCENT) (|a| + |b|) elements. Fingerprint space is cut into
P > k ranges; the part of a set in one range, hashed, is a coarse token, and sets that link share at least P - k of
them. P depends on the sizes, so sizes fall in classes a factor 100/PERCENT wide and a set has the tokens of its own class
and of the next. Small sets, whose parts would be too common, use pairs of parts. Empty parts are left out unless a set
has so many that they could be all it shares. So no frequent word, line or passage makes a frequent token: a token is
shared only where everything in its range agrees.

Token-group matrix.
1. Groups: from each token's list come pairs of a class with the list's first (all pairs of the shortest lists), of which
   those go that cannot share as many tokens as links need. A class is compared with the one that it meets most often, then with those of other groups. Pairs that link make components;
   pairs of half the threshold already make *families*, the groups that similar documents are partitioned into.
2. The matrix holds each family's union of tokens, as (token, family). A query's overlap with a family's union bounds
   its overlap with every member, so a query visits only families that share enough tokens with it. A token of very
   many families would make rows by the square; its list becomes a group of its own instead.
3. An opened family is compared in tiles: its sets are cut into blocks of bounded size, and each pair of blocks is one
   piece of work inside a task. There the same matrix is used on the shingles themselves: sets most of whose shingles
   nobody else has are left out, the others stand in small groups with the union of their shingles, and a query
   opens only groups whose union holds enough of it. Pairs that are in one component already are not looked at.
Lists whose classes are all in one component need no more work, which is what becomes of large groups of near copies; a
family whose members are alike but do not link costs the square of its number of blocks, not of its members, in rows,
and no pair of it is ever a row. Comparisons with one class are dealt to as many tasks as the bytes of its partners need. The
sets of classes that share a token are written once; the full table is shuffled once for that.

Edge cases: null and empty texts, and texts of blanks, have no shingles and link with nothing; a text of one to three
words is one shingle; repeated rows link like other copies; a null id is nobody's component (a component of only null
ids has a null component_id); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.storage import discard, materialise, sweep
from tessera.llm.common import flat, mix64, small_batches
from tessera.operators.graph import components

SHINGLE = 4
#: The threshold: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Sets up to this size use pairs of parts.
SMALL = 40
#: Parts beyond k, besides an eighth for empty ones (the smallest sets of a size class leave that many): about so many tokens
#: two linking sets share at least. A passage that many texts hold makes them share a token now and then, but hardly ever that many.
SLACK = 8
#: A list of no more classes than this has all its pairs compared at once.
SHORT = 3
BLOCK = 1 << 19
GATHER = 16 << 20
SHARD_BYTES = 4 << 20
#: Bytes of sets that one call compares with a class, and that one call of several small pieces of work gets about.
SLOT_BYTES = 4 << 20
#: A family has up to BLOCKS blocks of at least BLOCK_LEAST bytes, and more only where they would pass BLOCK_MOST.
BLOCKS, BLOCK_LEAST, BLOCK_MOST = 6, 1 << 19, 8 << 20
#: A token of more families than this makes its list a group of its own.
MANY = 32
#: Sets in one group of the matrix within a tile.
GROUP = 32

TOKEN = np.dtype([("token", "<u8"), ("cls", "<u8"), ("n", "<u4"), ("need", "u1")])

_B = 0x9E3779B97F4A7C15
_I = pow(_B, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_tables: dict[str, np.ndarray] = {}


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables["p"]) < n:
        size = max(n, BLOCK * 2)
        for name, base in (("p", _B), ("i", _I)):
            out = np.empty(size, np.uint64)
            out[0], m = 1, 1
            while m < size:
                k = min(m, size - m)
                out[m : m + k] = out[:k] * np.uint64(pow(base, m, 1 << 64))
                m += k
            _tables[name] = out
    return _tables["p"], _tables["i"]


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """A fingerprint of each word of one text, in order. Texts of any length, block by block at blanks."""
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK)
        if end < len(raw):  # cut at the last blank, or read on to the next
            blank = np.flatnonzero(_BLANK[raw[at:end]])
            if len(blank):
                end = at + int(blank[-1]) + 1
            else:
                while end < len(raw) and not _BLANK[raw[end]]:
                    end += 1
        part = _LOWER[raw[at:end]]
        word = np.concatenate([[False], ~_BLANK[part], [False]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        a, b = edge[::2], edge[1::2]
        p, inv = _table(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * p[: len(part)], out=sums[1:])
        out.append(mix64((sums[b] - sums[a]) * inv[a] + (b - a).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle fingerprints of a text's words."""
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    h = np.full(n, np.uint64(min(k, len(words))))
    for i in range(min(k, len(words))):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def set_key(tokens: np.ndarray) -> int:
    """64 bits that name a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little")


@lru_cache(maxsize=4096)
def scheme(level: int, percent: int = PERCENT) -> tuple[int, int, int, np.ndarray]:
    """Largest size, k, P and the ranges' ends of the size class `level`."""
    most = _bounds(level + 1, percent) - 1
    k = (100 - percent) * 2 * most // (100 + percent)
    parts = k + 2 if most <= SMALL else k + SLACK + (k + SLACK) // 8
    ends = np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)
    return most, k, parts, ends


@lru_cache(maxsize=4096)
def _bounds(level: int, percent: int) -> int:
    """Smallest size of a class: classes grow so that sizes that can link differ by one class at most."""
    return 1 if level == 0 else max(_bounds(level - 1, percent) + 1, -(-100 * _bounds(level - 1, percent) // percent))


def level_of(n: int, percent: int = PERCENT) -> int:
    level = 0
    while _bounds(level + 1, percent) <= n:
        level += 1
    return level


def coarse_tokens(tokens: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """The coarse tokens of a set, and how many of them any set it links with must share."""
    own = level_of(len(tokens), percent)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(tokens))])
    out, need = [], 255
    for level in (own, own + 1):
        most, k, parts, ends = scheme(level, percent)
        at = np.concatenate([[0], np.searchsorted(tokens, ends), [len(tokens)]])
        size = np.diff(at)
        part = mix64((sums[at[1:]] - sums[at[:-1]]) + size.astype(np.uint64))
        empty = int((size == 0).sum())
        must = parts - k  # parts that a linking set shares
        void = empty >= must
        names = np.arange(parts, dtype=np.uint64) + np.uint64(level << 32)
        if most <= SMALL:
            i, j = _pairs(parts)
            code = mix64(mix64(part[i] + names[i]) + part[j] * np.uint64(3) + names[j])
            out.append(code if void else code[(size[i] > 0) | (size[j] > 0)])
            need = 1
        else:
            code = mix64(part + names * np.uint64(0x9E3779B97F4A7C15))
            out.append(code if void else code[size > 0])
            need = min(need, 1 if void else must - empty)
    return np.concatenate(out), need


@lru_cache(maxsize=64)
def _pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.array(list(combinations(range(n), 2)), dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def links(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets link."""
    both = common(a, b)
    return bool(both) and 100 * both >= percent * (len(a) + len(b) - both)


def _pack(rows: np.ndarray) -> bytes:
    """Field by field; of a token the upper 40 bits: the lower ones have dealt it, and a chance match is only compared in vain."""
    top = rows["token"] >> np.uint64(24)
    planes = [(top >> np.uint64(32)).astype(np.uint8), top.astype(np.uint32), rows["cls"], rows["n"], rows["need"]]
    return np.int64(len(rows)).tobytes() + b"".join(np.ascontiguousarray(x).tobytes() for x in planes)


def _unpack(data: bytes) -> np.ndarray:
    n, at = int(np.frombuffer(data, "<i8", 1)[0]), 8
    rows = np.empty(n, TOKEN)
    rows["token"] = np.frombuffer(data, np.uint8, n, at).astype(np.uint64) << np.uint64(32) | np.frombuffer(data, "<u4", n, at + n)
    at += 5 * n
    for f in TOKEN.names[1:]:
        rows[f] = np.frombuffer(data, TOKEN[f], n, at)
        at += n * TOKEN[f].itemsize
    return rows


def pack_set(tokens: np.ndarray) -> bytes:
    """A sorted set by the upper 48 bits of its tokens, byte plane by byte plane, the highest first.

    Sets of n and m tokens are compared by these and agree by chance in about n m / 2^48 of them.
    """
    return b"".join((tokens >> np.uint64(8 * k)).astype(np.uint8).tobytes() for k in range(7, 1, -1))


def unpack_set(data: bytes) -> np.ndarray:
    n = len(data) // 6
    out = np.zeros(n, np.uint64)
    for k in range(6):
        out = out << np.uint64(8) | np.frombuffer(data, np.uint8, n, k * n)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _indexer(n_shards: int, k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            rows = np.concatenate(held)
            to = (rows["token"] % np.uint64(n_shards)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            rows, to = rows[order], to[order]
            cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            none = [None] * len(cut)
            packed = [_pack(rows[a:b]) for a, b in zip(cut, [*cut[1:], len(to)], strict=True)]
            yield _batch(none, none, none, none, none, to[cut].tolist(), packed)

        for batch in batches:
            raw, offsets = flat(batch.column(1))
            n, cls = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                tokens = shingles(word_hashes(raw[a:b]), k)
                key = set_key(tokens)
                n.append(len(tokens))
                cls.append(key - (1 << 64) if key >> 63 else key)
                if len(tokens) and key not in seen:  # of equal sets one is indexed
                    seen.add(key)
                    codes, need = coarse_tokens(tokens, percent)
                    e = np.empty(len(codes), TOKEN)
                    e["token"], e["cls"], e["n"], e["need"] = codes, np.uint64(key), len(tokens), need
                    held.append(e)
                    size += b - a
            lot = -1 - (cls[0] if cls else 0) % n_shards  # passes through any shard's task
            ids, hashes, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            yield _batch(ids, hashes, texts, n, cls, [lot] * len(n), [None] * len(n))
            if size >= GATHER:
                yield from flush()
                held, size = [], 0
                seen.clear()
        yield from flush()

    return run


_INDEX = "doc_id long, id_hash long, text_hash long, n long, cls long, shard long, records binary"


def _batch(*columns) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in _INDEX.split(", ")])


_LISTS = "a long, b long, met int, shorts int, size long, token long, need int, doc_id long, id_hash long, text_hash long, n long, cls long"


def _columns(rows: int, **columns) -> pa.Table:
    """A table of _LISTS with the given columns and nulls in the others."""
    kinds = {"long": pa.int64(), "int": pa.int32()}
    names = [x.split() for x in _LISTS.split(", ")]
    return pa.table({k: columns[k].cast(kinds[t]) if k in columns else pa.nulls(rows, kinds[t]) for k, t in names})


def _list_tokens(table: pa.Table, percent: int) -> pa.Table:
    """Of a shard's tokens: pairs (a, b, met, shorts, need, size), how often the first of a list met a member (all pairs of
    short lists, counted in shorts too), with the tokens that they would have to share and the size of set a; and
    (token, a, need) of the lists of more than SHORT. Documents' rows pass through.
    """
    if table.num_rows and table.column("shard")[0].as_py() < 0:
        own = {c: table.column(c).combine_chunks() for c in ("doc_id", "id_hash", "text_hash", "n", "cls")}
        return _columns(table.num_rows, **own)
    rows = np.concatenate([_unpack(x.as_py()) for x in table.column("records")])
    # Most tokens stand alone: only those that repeat are put in full order.
    order = np.argsort(rows["token"], kind="stable")
    token = rows["token"][order]
    same = token[1:] == token[:-1]
    repeats = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    rows = rows[order[repeats]]
    rows = rows[np.lexsort((rows["cls"], rows["token"]))]
    rows = rows[np.r_[True, (rows["token"][1:] != rows["token"][:-1]) | (rows["cls"][1:] != rows["cls"][:-1])]] if len(rows) else rows
    head = np.flatnonzero(np.r_[True, rows["token"][1:] != rows["token"][:-1]]) if len(rows) else np.zeros(0, np.int64)
    count = np.diff(np.r_[head, len(rows)])
    pairs = []
    for x in range(1, SHORT):
        for y in range(x):
            i = head[(count > x) & (count <= SHORT)]
            pairs.append((i + y, i + x))
    member = np.flatnonzero(np.repeat(count > SHORT, count))
    centre = np.repeat(head, count)[member]
    n_short = sum(len(p[0]) for p in pairs)
    pairs.append((centre[member != centre], member[member != centre]))
    i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    short = np.arange(len(i)) < n_short
    n = rows["n"].astype(np.int64)
    ok = np.minimum(n[i], n[j]) * 100 >= percent * np.maximum(n[i], n[j])
    i, j, short = i[ok], j[ok], short[ok]
    order = np.lexsort((rows["cls"][j], rows["cls"][i]))
    i, j, short = i[order], j[order], short[order]
    x, y = rows["cls"][i], rows["cls"][j]
    new = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(x) else np.zeros(0, np.int64)
    met = np.diff(np.r_[new, len(x)])
    shorts = np.add.reduceat(short, new, dtype=np.int64) if len(new) else new
    need = np.maximum(rows["need"][i[new]], rows["need"][j[new]]).astype(np.int32)
    kept = rows[member]
    return pa.concat_tables([
        _columns(len(new), a=_signed(x[new]), b=_signed(y[new]), met=pa.array(met), shorts=pa.array(shorts), need=pa.array(need), size=pa.array(n[i[new]])),
        _columns(len(kept), token=_signed(kept["token"]), a=_signed(kept["cls"]), need=pa.array(kept["need"].astype(np.int32))),
    ])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(cls, text) to (cls, n, tokens); rows that repeat id and text give one of a task."""
    seen: set[int] = set()
    for batch in batches:
        raw, offsets = flat(batch.column(1))
        out: list[list] = [[], [], []]
        for i, cls in enumerate(batch.column(0).to_pylist()):
            if cls not in seen:
                seen.add(cls)
                tokens = shingles(word_hashes(raw[offsets[i] : offsets[i + 1]]), k)
                for held, v in zip(out, (cls, len(tokens), pack_set(tokens)), strict=True):
                    held.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["cls", "n", "tokens"])


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """An order by keys, and the ranges in it that agree in all of them."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    cut = np.flatnonzero(new).tolist()
    return order, list(zip(cut, [*cut[1:], len(order)], strict=True))


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _compare_stars(table: pa.Table, percent: int) -> pa.Table:
    """(a, b, strong) of pairs that link or have half the similarity: each class a with the partners in this slot."""
    hub, cls, tokens = _numbers(table, "a"), _numbers(table, "cls"), table.column("tokens")
    order, ranges = _runs(hub)
    out: list[tuple[int, int, bool]] = []
    for x, y in ranges:
        at = order[x:y]
        a = int(hub[at[0]])
        sets = {int(cls[i]): unpack_set(tokens[int(i)].as_py()) for i in at}
        own = sets.pop(a)
        for b, s in sets.items():
            both = common(own, s)
            union = len(own) + len(s) - both
            if 100 * both >= percent // 2 * union:
                out.append((a, b, 100 * both >= percent * union))
    a, b, strong = zip(*out, strict=True) if out else ([], [], [])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "strong": pa.array(strong, pa.bool_())})


def _slots(rows: int, sets: DataFrame) -> int:
    """How many calls of about SLOT_BYTES compare so many sets."""
    return max(1, int(rows * 6 * (sets.agg(F.avg("n")).first()[0] or 0)) // SLOT_BYTES)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, strong) of the distinct pairs (a, b) of classes that link (strong) or are half as similar; size: of set a.

    A class's partners have about its size; as many as fill SLOT_BYTES are one piece of work.
    """
    pairs = materialise(pairs.select("a", "b", "size"), "pairs")
    n_slots = _slots(2 * pairs.count(), sets)
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) * F.max("size") * 6 / SLOT_BYTES).alias("parts"))
    partners = pairs.join(parts, "a").select(F.col("b").alias("cls"), "a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    owners = parts.select(F.col("a").alias("cls"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    # A class's parts are different slots' or, at worst, one slot's together.
    slot = F.pmod(F.xxhash64("a", "part"), F.lit(n_slots)).alias("slot")
    rows = partners.unionByName(owners).join(sets.select("cls", "tokens"), "cls").select(slot, "a", "cls", "tokens")
    found = materialise(rows.groupBy("slot").applyInArrow(lambda table: _compare_stars(table, percent), "a long, b long, strong boolean"), "near")
    discard(pairs)
    return found


def open_groups(sets: list[np.ndarray], root: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets of different roots, as many as join what they connect; of two sides, only across.

    The token-group matrix of one tile: groups of similar sets with their union, and queries that open them.
    """
    n = np.array([len(s) for s in sets], dtype=np.int64)
    across = bool(side.any())
    alive, first = np.arange(len(sets)), np.concatenate([[0], np.cumsum(n)])
    names = np.unique(np.concatenate(sets), return_inverse=True)[1]
    for _ in range(4):  # a set links with nobody if too few of its elements are anybody else's
        ids = np.concatenate([names[first[i] : first[i + 1]] for i in alive])
        times = np.bincount(ids)
        known = np.add.reduceat(times[ids] > 1, np.concatenate([[0], np.cumsum(n[alive])[:-1]]), dtype=np.int64)
        alive = alive[100 * known >= percent * n[alive]]
        if len(alive) < 2:
            return []
        if len(alive) == len(known):
            break
    # Similar sets stand together: by root, then by their smallest elements.
    small = np.array([[sets[i][0], sets[i][min(1, n[i] - 1)]] for i in alive])
    order = np.lexsort((small[:, 1], small[:, 0], root[alive]))
    alive = alive[order]
    ids = np.unique(np.concatenate([names[first[i] : first[i + 1]] for i in alive]), return_inverse=True)[1]
    size, part, s = n[alive], np.unique(root[alive], return_inverse=True)[1], side[alive]
    starts = np.concatenate([[0], np.cumsum(size)])
    mask = np.zeros(int(ids.max()) + 1, bool)
    out: list[tuple[int, int]] = []
    for g in range(0, len(alive), GROUP):
        h = min(len(alive), g + GROUP)
        union = ids[starts[g] : starts[h]]
        mask[union] = True
        shared = np.add.reduceat(mask[ids[starts[g] :]], starts[g:-1] - starts[g], dtype=np.int64)  # queries from the group on
        mask[union] = False
        ask = 100 * shared >= percent * np.maximum(size[g:], size[g:h].min())
        ask &= percent * size[g:] <= 100 * size[g:h].max()
        queries = g + np.flatnonzero(ask)
        for x in range(g, h):
            q = queries[(queries > x) & (part[queries] != part[x])]
            if across:
                q = q[s[q] != s[x]]
            if not len(q):
                continue
            own = ids[starts[x] : starts[x + 1]]
            mask[own] = True
            at = np.concatenate([[0], np.cumsum(size[q])])
            span = np.arange(at[-1]) + np.repeat(starts[q] - at[:-1], size[q])
            both = np.add.reduceat(mask[ids[span]], at[:-1], dtype=np.int64)
            mask[own] = False
            q = q[100 * both >= percent * (size[q] + size[x] - both)]
            for y in q.tolist():
                if part[y] != part[x]:
                    out.append((int(alive[x]), int(alive[y])))
                    part[part == part[y]] = part[x]
    return out


def _compare_tiles(table: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) of the tiles in this slot."""
    cls, root, side, tokens = _numbers(table, "cls"), _numbers(table, "root"), _numbers(table, "side"), table.column("tokens")
    order, ranges = _runs(_numbers(table, "grp"), _numbers(table, "tile"))
    a, b = [], []
    for x, y in ranges:
        at = order[x:y]
        sets = [unpack_set(tokens[int(i)].as_py()) for i in at]
        for i, j in open_groups(sets, root[at], side[at], percent):
            a.append(int(cls[at[i]]))
            b.append(int(cls[at[j]]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _in_tiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members (grp, cls, root) of one group but of different roots, compared tile by tile.

    Sets of one root that alone would fill a block have blocks of their own, and pairs of such blocks need no tile; so a
    component of any size costs its number of blocks times those of the rest of its group.
    """
    members = members.join(sets.select("cls", "n"), "cls")
    roots = members.groupBy("grp", "root").agg((6 * F.sum("n")).alias("bytes"))
    roots = roots.withColumn("large", F.col("bytes") > BLOCK_MOST).withColumn("unit", F.when(F.col("large"), F.col("root")).otherwise(0))
    roots = materialise(roots, "roots")
    several = roots.groupBy("grp").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("grp")
    n_blocks = F.greatest(F.least(F.ceil(F.col("bytes") / BLOCK_LEAST), F.lit(BLOCKS)), F.ceil(F.col("bytes") / BLOCK_MOST))
    units = roots.join(several, "grp").groupBy("grp", "large", "unit").agg(F.sum("bytes").alias("bytes")).withColumn("blocks", n_blocks)
    units = materialise(units, "units")
    total = units.agg(F.sum(F.col("bytes") * F.col("blocks"))).first()[0]
    u, v = units.alias("u"), units.alias("v")
    same = (F.col("u.large") == F.col("v.large")) & (F.col("u.unit") == F.col("v.unit"))
    after = F.struct("u.large", "u.unit") < F.struct("v.large", "v.unit")
    numbers = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    both = u.join(v, (F.col("u.grp") == F.col("v.grp")) & ((same & ~F.col("u.large")) | after))
    both = both.select("u.grp", same.alias("same"), *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "uv" for c in ("large", "unit", "blocks")])
    tiles = both.withColumn("i", numbers("u_blocks")).withColumn("j", numbers("v_blocks")).filter("not same or i <= j")
    tiles = tiles.withColumn("tile", F.xxhash64("u_large", "u_unit", "i", "v_large", "v_unit", "j"))
    left = F.struct(F.col("u_large").alias("large"), F.col("u_unit").alias("unit"), F.col("i").alias("block"), F.lit(0).alias("side"))
    right = F.struct(F.col("v_large").alias("large"), F.col("v_unit").alias("unit"), F.col("j").alias("block"), F.lit(1).alias("side"))
    ends = F.when(F.col("same") & (F.col("i") == F.col("j")), F.array(left)).otherwise(F.array(left, right))
    ends = tiles.select("grp", "tile", F.explode(ends).alias("e")).select("grp", "tile", "e.*")
    placed = members.join(roots.select("grp", "root", "large", "unit"), ["grp", "root"]).join(units.select("grp", "large", "unit", "blocks"), ["grp", "large", "unit"])
    placed = placed.select("grp", "large", "unit", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block"), "cls", "root")
    slot = F.pmod(F.xxhash64("grp", "tile"), F.lit(max(1, int(total or 0) // SLOT_BYTES))).alias("slot")
    rows = placed.join(ends, ["grp", "large", "unit", "block"]).join(sets.select("cls", "tokens"), "cls").select(slot, "grp", "tile", "side", "cls", "root", "tokens")
    found = materialise(rows.groupBy("slot").applyInArrow(lambda table: _compare_tiles(table, percent), "a long, b long"), "near")
    discard(roots, units)
    return found


def _with_root(rows: DataFrame, groups: DataFrame, key: str, name: str) -> DataFrame:
    """rows with the root of their column key, itself where no link has it."""
    to = groups.select(F.col("key").alias(key), F.col("root").alias(name))
    return rows.join(to, key, "left").withColumn(name, F.coalesce(name, key))


def _reaching(rows: DataFrame, group: str) -> DataFrame:
    """Those of rows (token, ...) whose token occurs in several groups."""
    several = rows.groupBy("token").agg(F.min(group).alias("x"), F.max(group).alias("y")).filter("x <> y")
    return rows.join(several.select("token"), "token")


def _can_link(pairs: DataFrame, inside: DataFrame) -> DataFrame:
    """Pairs that may share as many tokens as links need: the short lists that both are in, all counted, and at most the long lists (cls, inside) of either one."""
    of = lambda c: inside.select(F.col("cls").alias(c), F.col("inside").alias(f"inside_{c}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    longs = F.least(F.coalesce("inside_a", F.lit(0)), F.coalesce("inside_b", F.lit(0)))
    return both.filter(F.col("shorts") + longs >= F.col("need")).select(*pairs.columns)


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and cls, the class of equal sets it is in."""
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    # Two hashes, of the text and of text and id, name a row: 128 bits.
    base = docs.select("doc_id", text.alias("text"), F.xxhash64(text, F.lit(17), "doc_id").alias("id_hash"), F.xxhash64(text).alias("text_hash"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = max(4, size // SHARD_BYTES)
    index = base.select("doc_id", "text", "id_hash", "text_hash").mapInArrow(_indexer(n_shards, k, percent), _INDEX)
    lists = materialise(index.groupBy("shard").applyInArrow(lambda table: _list_tokens(table, percent), _LISTS), "lists")
    sweep(docs.sparkSession)
    members = lists.filter("n IS NOT NULL").select("doc_id", "id_hash", "text_hash", "n", "cls")
    reps = members.filter("n > 0").groupBy("cls").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id_hash", "text_hash")).alias("r"))
    reps = materialise(reps.select("cls", "r.doc_id", "r.id_hash", "r.text_hash"), "classes")

    long_ = lists.filter("token IS NOT NULL").select("token", F.col("a").alias("cls"), "need")
    inside = long_.groupBy("cls").agg(F.count(F.lit(1)).alias("inside"), F.max("need").alias("least"))
    pairs = lists.filter("met IS NOT NULL").groupBy("a", "b").agg(*[f(c).alias(c) for f, c in ((F.sum, "met"), (F.sum, "shorts"), (F.max, "need"), (F.max, "size"))])
    pairs = materialise(_can_link(pairs, inside), "pairs")
    # A pair that no short list holds shares only long ones: a class in too few of them needs no more work.
    long_ = long_.join(inside.filter("inside >= least"), "cls", "left_semi")
    active = pairs.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(long_.select("cls")).distinct()
    where = materialise(active.join(reps, "cls").select("cls", "id_hash", "text_hash"), "active")
    # The active classes grow with the table, so they are never broadcast.
    rows = base.join(where.hint("merge"), ["id_hash", "text_hash"]).select("cls", "text")
    sets = materialise(rows.mapInArrow(lambda batches: _sets(batches, k), "cls long, n long, tokens binary"), "sets")
    sweep(docs.sparkSession)
    if sets.count() > where.count():  # rows that repeat id and text, in several tasks
        sets = materialise(sets.dropDuplicates(["cls"]), "sets")
    discard(where)

    # 1. Each class with the one it met most, then what still joins different families.
    pairs = pairs.join(pairs.groupBy("b").agg(F.max_by("a", F.struct("met", -F.col("a").cast("decimal(20,0)"))).alias("best")), "b")
    found = _verified(pairs.filter("a = best"), sets, percent)
    families = components(found)
    far = _reaching(_with_root(long_, families, "cls", "family"), "family").groupBy("cls").agg(F.count(F.lit(1)).alias("inside"))
    left = _with_root(_with_root(pairs.filter("a <> best"), families, "a", "ra"), families, "b", "rb")
    more = _verified(_can_link(left.filter("ra <> rb"), far), sets, percent)
    found = found.unionByName(more)
    if more.take(1):
        families = components(found)
    groups = components(found.filter("strong"))
    # 2. The matrix, over lists that reach into more than one component.
    enough = lambda r: r.join(r.groupBy("cls").agg(F.count(F.lit(1)).alias("held"), F.max("need").alias("least")).filter("held >= least"), "cls", "left_semi")
    rows = enough(_reaching(_with_root(long_, groups, "cls", "root"), "root"))
    rows = materialise(_with_root(rows, families, "cls", "family"), "rows")
    wide = materialise(_reaching(enough(_reaching(rows, "family")), "family"), "wide")
    reach = wide.select("token", "family").distinct().groupBy("token").agg(F.count(F.lit(1)).alias("families"))
    wide = wide.join(reach, "token")
    named = lambda kind, c: F.xxhash64(F.lit(kind), c).alias("grp")
    hot = wide.filter(F.col("families") > MANY).select(named("list", "token"), "cls", "root")
    wide = wide.filter(F.col("families") <= MANY)
    sizes = rows.select("family", "cls").distinct().groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    asks = wide.join(sizes, "family").select("token", "cls", "root", "need", F.col("family").alias("own"), F.col("members").alias("own_members"))
    matrix = wide.select("token", "family").distinct().join(sizes, "family")
    # The smaller family asks, the larger one answers: one of the two directions is enough.
    overlap = asks.join(matrix, "token").filter("own_members < members OR (own_members = members AND own < family)")
    visits = overlap.groupBy("cls", "root", "family").agg(F.count(F.lit(1)).alias("shared"), F.max("need").alias("need")).filter("shared >= need")
    # Pairs of short lists have been compared, but for those within one family.
    inner = _with_root(_with_root(pairs, families, "a", "fa"), families, "b", "fb").filter("fa = fb").select("a", "b", F.col("fa").alias("family"))
    inner = _with_root(_with_root(inner, groups, "a", "ra"), groups, "b", "rb").filter("ra <> rb")
    inner = inner.select("family", F.explode(F.array(F.struct(F.col("a").alias("cls"), F.col("ra").alias("root")), F.struct(F.col("b").alias("cls"), F.col("rb").alias("root")))).alias("e"))
    opened = rows.select(named("family", "family"), "cls", "root").unionByName(visits.select(named("family", "family"), "cls", "root"))
    opened = opened.unionByName(inner.select(named("family", "family"), "e.cls", "e.root")).unionByName(hot).distinct()
    opened = materialise(opened, "opened")
    # 3. Opened families, tile by tile.
    if opened.take(1):
        last = _in_tiles(opened, sets, percent)
        if last.take(1):
            groups = components(found.filter("strong").select("a", "b").unionByName(last))
    discard(sets, rows, opened)
    root = reps.join(groups, reps.cls == groups.key, "left").select("cls", F.coalesce("root", "cls").alias("root"), "doc_id")
    least = root.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    label = root.join(least, "root").select("cls", "component_id")
    return members.join(label, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "cls", "id_hash", "text_hash"
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each component, the one of smallest id; columns as they were.

    Documents without shingles all stay; of a component of null ids, and of rows that repeat id and text, all rows of
    the winning text stay.
    """
    rows = jaccard_components(docs, k, percent)
    stay = materialise(rows.filter("n_shingles = 0 OR doc_id <=> component_id").select("id_hash", "text_hash").distinct(), "stay").alias("k")
    text = F.coalesce("d.text", F.lit(""))
    same = (F.xxhash64(text, F.lit(17), "d.doc_id") == F.col("k.id_hash")) & (F.xxhash64(text) == F.col("k.text_hash"))
    return docs.alias("d").join(stay, same, "left_semi")
