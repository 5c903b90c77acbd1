"""Exact substring deduplication with a logarithmic family of suffix arrays.

Every byte goes that a string of ``length`` bytes covers which also starts in a document with a
smaller id. Equal strings are found through sampled suffixes: of the 16-byte prefixes inside each
string of ``length`` bytes the one with the least hash is its anchor, so equal strings have equal
anchors at equal offsets, and only about one position in eighteen is kept.

1. The documents are dealt once into batches of bounded bytes, by a hash of the id, and written
   bucketed by batch; every later scan reads these files in place.
2. A batch's suffix array holds its anchors in the order of their prefix hashes. Range by range of
   that order, the batches' arrays meet and tell each batch which of its anchors others have too.
   A prefix that many documents of a batch share is in its array once.
3. For those anchors the batch sends the bytes around them (equal surroundings once, from the
   smallest id). Within a range all strings of ``length`` bytes around the anchors form suffix
   arrays again, batch by batch in order of ids: a new batch is merge-scanned against the
   existing levels and its strings found there are marked; then it becomes a level, and levels of equal
   size merge, so there are logarithmically many.
4. The marks return to their batches; a last scan of the bucketed files removes the covered bytes.

Ranges and batches are of bounded size, however much data there is, and one prefix or passage
counts once per batch, so frequent passages gather nowhere. Hashes of 64 bits name prefixes and
strings; a string must agree in both its own hash and its anchor's.

Corner cases: null and empty texts keep nothing and lose nothing; texts shorter than ``length``
lose nothing; texts of any length are scanned in overlapping pieces; rows that repeat an id do not
count as each other's source; rows with a null id are returned whole and are no source; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm import textscan
from eventflow.llm.shared import Tables
from eventflow.llm.textscan import mix, powers, text_buffers

LENGTH, PREFIX = 50, 16
BATCH_BYTES, PIECE_BYTES, BUCKET_BYTES, RANGE_BYTES = 4 << 20, 1 << 20, 16 << 20, 8 << 20
# Strings that are hashed, or whose anchors are looked for, together: in the processor's cache.
BLOCK = 1 << 14
# Kinds of what is sent to batches: the first byte of a blob.
SHARED, MARKS = b"S", b"M"
# Strings in one new batch of a range's family.
FAMILY_BATCH = 1 << 18


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of equal weight lie together."""
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a)
        planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if len(raw) else b""
        out.append(len(raw).to_bytes(8, "little") + planes)
    return zlib.compress(b"".join(out), 1)


def unpack(blob: bytes, *types) -> list[np.ndarray]:
    raw, at, out = zlib.decompress(blob), 0, []
    for t in types:
        t = np.dtype(t)
        n = int.from_bytes(raw[at:at + 8], "little")
        at += 8
        planes = np.frombuffer(raw, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(t))
        at += n * t.itemsize
    return out


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64)[0], dtype=np.uint64)


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every run of ``length`` bytes."""
    n = len(data) - length + 1
    out = np.empty(max(n, 0), np.uint64)
    for lo in range(0, n, BLOCK):
        part = data[lo:lo + BLOCK + length - 1]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(textscan._VALUES[part] * powers(textscan._BASE, len(part)), out=sums[1:])
        got = sums[length:] - sums[:-length]
        out[lo:lo + BLOCK] = mix(got * powers(textscan._BASE_INVERSE, len(got)))
    return out


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value of every run of ``width`` values."""
    n = len(values) - width + 1
    place = np.empty(max(n, 0), np.int32)
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        part = values[lo:hi + width - 1]
        best, span = part, 1
        while span < width:
            step = min(span, width - span)
            best = np.minimum(best[:-step], best[step:])
            span += step
        # The place is looked up only where the least value changes.
        start = np.concatenate([[0], np.flatnonzero(best[1:] != best[:-1]) + 1])
        runs = np.diff(start, append=hi - lo)
        at = np.lib.stride_tricks.sliding_window_view(part, width)[start].argmin(axis=1)
        # A value that stays the least beyond its place comes again later: places are followed one by one.
        place[lo:hi] = _followed_places(part, width) if (runs > at + 1).any() else np.repeat(start + at, runs)
        place[lo:hi] += lo
    return place


def _followed_places(values: np.ndarray, width: int) -> np.ndarray:
    """As ``_least_places``, with every place carried along."""
    best, place, span = values, np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        take = right < left
        place = np.where(take, place[step:], place[:-step])
        best = np.where(take, right, left)
        span += step
    return place


class Anchors:
    """Anchors of the documents of a batch: ``at`` (byte), ``row``, ``key``, and the strings they
    stand for, which start ``low`` to ``high`` bytes before ``at``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        parts = []
        for lo, hi in _pieces(offsets, length):
            keys = window_hashes(data[lo:hi], PREFIX)
            if hi - lo < length:
                continue
            place = _least_places(keys, length - PREFIX + 1)
            r0, r1 = int(np.searchsorted(offsets, lo, side="right")) - 1, int(np.searchsorted(offsets, hi, side="left"))
            # Runs of strings that have one anchor, cut where a row begins or its last string has begun.
            begin = np.maximum(offsets[r0:r1], lo)
            cuts = np.concatenate([begin, np.maximum(offsets[r0 + 1:r1 + 1] - length + 1, begin)]) - lo
            edge = np.empty(len(place), dtype=bool)
            edge[0] = True
            np.not_equal(place[1:], place[:-1], out=edge[1:])
            edge[cuts[cuts < len(place)]] = True
            new = np.flatnonzero(edge)
            last = np.append(new[1:], len(place)) - 1
            row = np.searchsorted(offsets, new + lo, side="right") - 1
            inside = new + (lo + length) <= offsets[row + 1]
            new, last, row = new[inside], last[inside], row[inside]
            if not len(new):
                continue
            at = place[new]
            # Anchors have small hashes by choice; mixed again, they spread evenly over the ranges.
            parts.append((at + np.int64(lo), row, mix(keys[at] + np.uint64(1)), at - last, at - new))
        if parts:
            self.at, self.row, self.key, self.low, self.high = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            self.at = self.row = self.low = self.high = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("at", "row", "key", "low", "high"):
            setattr(self, name, getattr(self, name)[chosen])


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Byte ranges that hold every string of ``length`` bytes of a row in at least one range."""
    for lo, hi in textscan.chunks(offsets, PIECE_BYTES):
        start, end = int(offsets[lo]), int(offsets[hi])
        while end - start > PIECE_BYTES + length:
            yield start, start + PIECE_BYTES + length - 1
            start += PIECE_BYTES
        yield start, end


class Batch:
    """The documents of a slot, in order of ids, and what was sent to it."""

    def __init__(self, key, rows: pa.Table, sent: pa.Table | None = None):
        self.slot = key[0].as_py()
        rows = rows.sort_by([("id", "ascending"), ("tie", "ascending")]).combine_chunks()
        self.ids = rows["id"].to_numpy()
        column = rows["text"].combine_chunks()
        column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks or [pa.array([], column.type)])
        self.data, self.offsets = text_buffers(column)
        got = {(r["blob"][:1], r["range"]): r["blob"][1:] for r in sent.to_pylist()} if sent is not None else {}
        self.shared, self.marks = ([got[k] for k in sorted(got) if k[0] == kind] for kind in (SHARED, MARKS))


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


SENT = "slot int, range int, blob binary"


def _rows(found: list[tuple]) -> pa.Table:
    columns = list(zip(*found, strict=True)) if found else [[]] * 3
    types = [pa.int32(), pa.int32(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["slot", "range", "blob"])


def _cut(keys: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of sorted keys, ranges without keys left out."""
    if not len(keys):
        return []
    own = _ranges(keys, ranges)
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    return [(int(own[a]), int(a), int(b)) for a, b in zip(first, np.append(first[1:], len(own)), strict=True)]


def _arrays(length: int, ranges: int):
    """Each batch's distinct anchor keys, sorted, in ranges."""
    def run(key, rows):
        b = Batch(key, rows)
        keys = np.unique(Anchors(b.data, b.offsets, length).key)
        return _rows([(b.slot, r, pack_sorted(keys[lo:hi])) for r, lo, hi in _cut(keys, ranges)])
    return run


def _meet(key, table):
    """Per batch of a range: whether each of its keys is in another batch's array too."""
    arrays = [unpack_sorted(b.as_py()) for b in table.column("blob")]
    keys = np.concatenate(arrays)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    both = np.zeros(len(keys), dtype=bool)
    both[order[1:][same]] = True
    both[order[:-1][same]] = True
    parts = np.split(both, np.cumsum([len(a) for a in arrays])[:-1])
    return pa.table({"slot": table.column("slot"), "range": table.column("range"),
                     "blob": pa.array([SHARED + pack(np.packbits(p), np.array([len(p)], np.int64)) for p in parts], pa.binary())})


class Shared:
    """A batch's anchors whose key is in several documents, grouped by equal surroundings."""

    def __init__(self, b: Batch, length: int):
        a = Anchors(b.data, b.offsets, length)
        keys, inverse = np.unique(a.key, return_inverse=True)
        elsewhere = [np.unpackbits(bits, count=int(n[0])).astype(bool) for bits, n in (unpack(s, np.uint8, np.int64) for s in b.shared)]
        elsewhere = np.concatenate(elsewhere) if elsewhere else np.zeros(len(keys), dtype=bool)
        ids = b.ids[a.row]
        low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, inverse, ids)
        np.maximum.at(high, inverse, ids)
        a.keep((elsewhere | (low != high))[inverse])
        self.anchors, self.ids = a, b.ids[a.row]
        # Surroundings: from the first string's start to the last one's end.
        start, stop = a.at - a.high, a.at - a.low + length
        around = _hash_spans(b.data, start, stop) ^ mix((a.high * 64 + a.low).astype(np.uint64))
        order = np.lexsort((self.ids, around, a.key))
        new = np.concatenate([[True], (around[order[1:]] != around[order[:-1]]) | (a.key[order[1:]] != a.key[order[:-1]])]) if len(order) else np.zeros(0, dtype=bool)
        self.first = order[new]  # the smallest id of each group
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.start, self.stop = start, stop


def _hash_spans(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of data[start:stop] per span, piece by piece (spans are short)."""
    out = np.empty(len(start), np.uint64)
    order = np.argsort(start, kind="stable")
    ordered, at = start[order], 0
    while at < len(order):
        lo = int(ordered[at])
        to = int(np.searchsorted(ordered, lo + PIECE_BYTES, side="left"))
        some = order[at:to]
        hi = int(stop[some].max())
        part = data[lo:hi]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(textscan._VALUES[part] * powers(textscan._BASE, len(part)), out=sums[1:])
        out[some] = mix((sums[stop[some] - lo] - sums[start[some] - lo]) * powers(textscan._BASE_INVERSE, len(part))[start[some] - lo])
        at = to
    return out


def _surroundings(length: int, ranges: int):
    """Each batch's groups of equal surroundings of shared anchors, by key, in ranges."""
    def run(key, rows, sent):
        b = Batch(key, rows, sent)
        s = Shared(b, length)
        a, out = s.anchors, []
        for r, lo, hi in _cut(a.key[s.first], ranges):
            f = s.first[lo:hi]
            sizes = s.stop[f] - s.start[f]
            inside = np.arange(sizes.sum()) + np.repeat(s.start[f] - np.cumsum(sizes) + sizes, sizes)
            out.append((b.slot, r, pack(a.key[f], s.ids[f], a.low[f].astype(np.uint8), a.high[f].astype(np.uint8), b.data[inside])))
        return _rows(out)
    return run


class Family:
    """Sorted levels of (string, anchor key) pairs, of geometrically growing sizes."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, strings: np.ndarray) -> np.ndarray:
        """Merge-scan of a new batch against all levels: whether each string is in one; then the
        batch becomes a level and equal-sized levels merge."""
        order = np.argsort(strings, kind="stable")
        new = strings[order]
        found = np.zeros(len(new), dtype=bool)
        for level in self.levels:
            at = np.searchsorted(level, new)
            at[at == len(level)] = 0
            found |= level[at] == new
        out = np.empty(len(new), dtype=bool)
        out[order] = found
        fresh = new[~found]
        fresh = fresh[np.concatenate([[True], fresh[1:] != fresh[:-1]])] if len(fresh) else fresh
        if len(fresh):
            self.levels.append(fresh)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(np.sort(np.concatenate([a, b]), kind="stable"))
        return out


def _match(length: int):
    def run(key, table):
        """Per batch of a range: for each of its groups the offsets (bits) whose string also starts
        in a document with a smaller id."""
        arrays = [unpack(blob.as_py(), np.uint64, np.int64, np.uint8, np.uint8, np.uint8) for blob in table.column("blob")]
        counts = [len(a[0]) for a in arrays]
        keys, ids, low, high, data = (np.concatenate(x) for x in zip(*arrays, strict=True))
        del arrays
        sizes = high.astype(np.int64) - low + length
        per = sizes - length + 1  # strings of each group, one per offset
        first = np.cumsum(per) - per
        own = np.repeat(np.arange(len(keys)), per)
        back = np.arange(len(own)) - first[own]
        start = (np.cumsum(sizes) - sizes)[own] + back
        strings = mix(_hash_spans(data, start, start + length) ^ (keys[own] * np.uint64(0x9E3779B97F4A7C15)))
        del start, data
        bit = np.uint64(1) << (high[own].astype(np.int64) - back).astype(np.uint64)
        del back
        marks = np.zeros(len(keys), np.uint64)
        order = np.argsort(ids, kind="stable")
        ordered, ends = ids[order], np.cumsum(per[order])
        family, at = Family(), 0
        while at < len(order):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + FAMILY_BATCH, side="right")))
            to = int(np.searchsorted(ordered, ordered[to - 1], side="right"))  # a document stays in one batch
            some = order[at:to]
            n = per[some]
            mine = np.arange(n.sum()) + np.repeat(first[some] - np.cumsum(n) + n, n)
            new = strings[mine]
            hit = family.add(new)
            # Within the batch: a string that an earlier document of it has.
            o = np.argsort(new, kind="stable")  # the order of ids is kept among equals
            s, d = new[o], ids[own[mine]][o]
            starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            hit[o] |= d > np.repeat(d[starts], np.diff(np.append(starts, len(s))))
            np.bitwise_or.at(marks, own[mine[hit]], bit[mine[hit]])
            at = to
        parts = np.split(marks, np.cumsum(counts)[:-1])
        return pa.table({"slot": table.column("slot"), "range": table.column("range"),
                         "blob": pa.array([MARKS + pack(p) for p in parts], pa.binary())})
    return run


def _remove(length: int, keep_text: bool):
    """The final figures (and texts) of every document of a bucket."""
    def run(key, rows, sent):
        b = Batch(key, rows, sent)
        marks = [unpack(m, np.uint64)[0] for m in b.marks]
        s = Shared(b, length)
        a = s.anchors
        marks = np.concatenate(marks) if marks else np.zeros(len(s.first), np.uint64)
        mask = marks[s.group] if len(s.group) else np.zeros(0, np.uint64)
        # A document that repeats a smaller id's surroundings has all its strings there.
        copy = s.ids > s.ids[s.first][s.group] if len(s.group) else np.zeros(0, dtype=bool)
        delta = np.zeros(len(b.data) + 1, np.int32)
        for back in range(length - PREFIX + 1):
            on = ((mask >> np.uint64(back)) & np.uint64(1)).astype(bool) | (copy & (a.low <= back) & (back <= a.high))
            np.add.at(delta, a.at[on] - back, 1)
            np.add.at(delta, a.at[on] - back + length, -1)
        gone = np.cumsum(delta[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        begin = b.offsets[:-1][b.offsets[:-1] < len(gone)]
        edge[begin] = gone[begin]
        spans = np.concatenate([[0], np.cumsum(edge)])
        kept = [b.data[lo:hi][~gone[lo:hi]].tobytes() for lo, hi in zip(b.offsets[:-1], b.offsets[1:], strict=True)]
        columns = [pa.array(kept, pa.binary())] if keep_text else []
        return pa.Table.from_arrays(
            [pa.array(b.ids), pa.array(np.diff(b.offsets)), pa.array(total[b.offsets[1:]] - total[b.offsets[:-1]]), pa.array(spans[b.offsets[1:]] - spans[b.offsets[:-1]]),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept]), *columns],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + len(columns)])
    return run


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_text: bool = False,
                   tables: Tables | None = None) -> DataFrame:
    """One row per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``keep_text``, the
    remaining bytes (``kept``)."""
    spark = df.sparkSession
    tables = tables or Tables(spark, "suffix")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = docs.where(F.col("id").isNotNull())
    size = named.agg(F.sum(F.octet_length("text")).alias("n")).head()["n"] or 0
    slots, ranges = max(1, -(-size // BATCH_BYTES)), max(1, -(-size // RANGE_BYTES))
    buckets = max(1, -(-size // BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"eventflow_suffix_{uuid.uuid4().hex}"
    slot = F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int")
    (named.withColumns({"slot": slot, "tie": F.xxhash64("text")}).repartition(buckets, "slot").write.bucketBy(buckets, "slot").sortBy("slot")
     .option("path", f"{tables.root}/docs").option("compression", "zstd").saveAsTable(name))
    batches = spark.table(name).groupBy("slot")
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    columns = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text
    arrays = batches.applyInArrow(_arrays(length, ranges), SENT)
    shared = tables.put(arrays.groupBy("range").applyInArrow(_meet, SENT), "shared")
    around = batches.cogroup(shared.groupBy("slot")).applyInArrow(_surroundings(length, ranges), SENT)
    marks = tables.put(around.groupBy("range").applyInArrow(_match(length), SENT), "marks")
    done = tables.finish(batches.cogroup(shared.unionByName(marks).groupBy("slot")).applyInArrow(_remove(length, keep_text), schema))
    spark.sql(f"DROP TABLE {name}")
    rest = docs.where(F.col("id").isNull()).select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                                                   F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.encode("text", "UTF-8").alias("kept"))
    return done.unionByName(rest.select(*columns)).withColumnRenamed("id", id_col)
