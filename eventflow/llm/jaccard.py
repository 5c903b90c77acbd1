"""Exact n-gram Jaccard join with set-relation skipping.

A document's set holds the hashes of its distinct word n-grams; two documents link when the sets'
Jaccard similarity reaches a threshold. The result is each document's component.

1. A sketch of the n-gram frequencies (a fixed-size table, whatever the input) gives one order of
   all n-grams, rare ones first; by the prefix principle two linked sets share an n-gram among the
   first few of each. The order only affects speed.
2. Equal sets form one class, whose smallest id stands for it.
3. Answers by relation: classes that share some min-hashes with one of more frequent n-grams
   (the one with the fewest edits of its group) are checked against it first. A confirmed class takes over its leader's component, and from then on
   only pairs across components are looked at, so a group of near copies costs one check each.
4. Index lists by position: each prefix n-gram's list is cut into blocks of one position, sorted
   by set size. A pair of blocks is entered only for the sizes whose best possible overlap from
   these positions reaches the threshold; the rest of a block is skipped by binary search. A pair
   that also shares the n-gram before is skipped: it was met there.
5. The remaining pairs are held against each other by their prefixes, which bound the overlap, and
   then verified on the whole sets; links join the components.

Lists of n-grams that the sketch finds in very many documents are first reduced to those that
touch several components and dealt out by pairs of blocks of bounded rows. Texts move only for
documents that have a pair to verify. Tables between steps are written to the shared folder.

Corner cases: null, empty and blank texts have an empty set, link with nothing and are their own
component; a text with fewer words than n has its whole word sequence as its one n-gram; rows that
repeat an id are one document that has either text; rows with a null id get a null component and
link with nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.components import components
from eventflow.llm.shared import Tables
from eventflow.llm.textscan import Words, chunks, mix, text_buffers

# The frequency sketch: a counter for this many bytes of text, between 2**18 and 2**23 counters (one
# byte each when sent to the tasks), and the slices in which tasks' counts meet.
BYTES_A_COUNTER, LEAST_BITS, MOST_BITS, SLICES = 100, 18, 23, 16
# A list whose n-gram may be in more documents than this is dealt out in blocks of this many rows.
HOT_LIST, HOT = 4096, 128
MIN_HASHES, SHARED_HASHES, LEADERS = 8, 3, 2


def sets_of(batch: pa.RecordBatch, column: int, size: int) -> Iterator[np.ndarray]:
    data, offsets = text_buffers(batch.column(column))
    for lo, hi in chunks(offsets):
        yield from Words(data, offsets[lo:hi + 1]).shingle_sets(size)


def _count(size: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for lo, hi in chunks(offsets):
                for s in Words(data, offsets[lo:hi + 1]).shingle_sets(size):
                    np.add.at(counts, (s & np.uint64((1 << bits) - 1)).astype(np.int64), 1)
        if counts.any():
            for k, part in enumerate(np.split(counts, SLICES)):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["slice", "counts"])
    return run


def _merge(key, table):
    total = None
    for blob in table.column("counts"):
        part = np.frombuffer(zlib.decompress(blob.as_py()), np.uint32)
        total = part.astype(np.uint64) if total is None else total + part
    total = np.minimum(total, 2**32 - 1).astype(np.uint32)
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def sketch(texts: DataFrame, size: int) -> np.ndarray:
    """Counters of n-gram hashes over all texts: at least each n-gram's document frequency."""
    total = texts.agg(F.sum(F.octet_length(texts.columns[0])).alias("n")).head()["n"] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (int(total) // BYTES_A_COUNTER).bit_length()))
    parts = texts.mapInArrow(_count(size, bits), "slice int, counts binary").groupBy("slice").applyInArrow(_merge, "slice int, counts binary")
    out = np.zeros((SLICES, (1 << bits) // SLICES), np.uint32)
    for r in parts.toLocalIterator():  # a table of bounded size
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return out.ravel()


class Order:
    """One order of all n-grams: by the sketch's frequency level, then by hash."""

    def __init__(self, counts: np.ndarray):
        usual = max(4.0, 2.0 * float(np.median(counts)))
        self.level = np.ceil(np.log2(np.maximum(counts / usual, 1.0))).astype(np.uint8)
        self.level[counts > HOT_LIST] |= HOT  # the most frequent come last in any case

    def place(self, s: np.ndarray) -> np.ndarray:
        return (s & np.uint64(len(self.level) - 1)).astype(np.int64)

    def sort(self, s: np.ndarray) -> np.ndarray:
        return s[np.lexsort((s, self.level[self.place(s)]))]


def prefix_length(n: int, num: int, den: int) -> int:
    """First n-grams of a set of n of which a linked set shares one: n - ceil(t n) + 1."""
    return n - -(-num * n // den) + 1 if n else 0


def _describe(shared, size: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            n, one, two, prefix, hot, hashes, common = [], [], [], [], [], [], []
            for s in sets_of(batch, 1, size):
                n.append(len(s))
                d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                one.append(int(d[0]))
                two.append(int(d[1]))
                ordered = order.sort(s)
                head = ordered[:prefix_length(len(s), num, den)]
                prefix.append(head.view(np.int64))
                hot.append(order.level[order.place(head)] >= HOT)
                common.append(int((order.level[order.place(s)] & (HOT - 1)).sum(dtype=np.int64)) * 1024 // max(1, len(s)))
                hashes.append(np.array([mix(s ^ np.uint64(0x9E3779B9 * (k + 1))).min() for k in range(MIN_HASHES)] if len(s) else [], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                                              pa.array(prefix, pa.list_(pa.int64())), pa.array(hot, pa.list_(pa.bool_())), pa.array(hashes, pa.list_(pa.int64())), pa.array(common, pa.int64())],
                                             names=["id", "n", "d1", "d2", "prefix", "hot", "hashes", "common"])
    return run


def _pack_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets_of(batch, 1, size)], pa.binary())], names=["node", "members"])
    return run


def _overlaps(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = (np.frombuffer(c.as_py(), np.uint64) for c in (a, b))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum()) if len(y) else 0
                keep.append(den * both >= num * (len(x) + len(y) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def _heads_overlap(shared, num: int, den: int):
    """Keeps the pairs that their prefixes do not rule out. Up to the lesser of the two prefixes'
    last n-grams both sets are known, so they share what the prefixes share there and at most what
    the smaller rest holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            keep = []
            sizes = zip(batch.column("n").to_pylist(), batch.column("m").to_pylist(), strict=True)
            for a, b, (n, m) in zip(batch.column("left"), batch.column("right"), sizes, strict=True):
                x, y = (c.values.to_numpy().view(np.uint64) for c in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ends = [(int(order.level[order.place(z[-1:])][0]), int(z[-1])) for z in (x, y)]
                # The prefix that ends first is known whole; the other one up to there.
                rest = n - len(x) if ends[0] <= ends[1] else m - len(y)
                keep.append((both + rest) * (den + num) >= num * (n + m))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def possible(pairs: DataFrame, reps: DataFrame, shared, num: int, den: int) -> DataFrame:
    """The pairs (u, v) that the prefixes of both do not rule out."""
    left = reps.select(F.col("node").alias("u"), "n", F.col("prefix").alias("left"))
    right = reps.select(F.col("node").alias("v"), F.col("n").alias("m"), F.col("prefix").alias("right"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "n", "m", "left", "right").mapInArrow(_heads_overlap(shared, num, den), "u long, v long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs (u, v) whose whole sets link. Only the texts of documents in pairs are moved."""
    needed = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    sets = docs.join(needed.hint("shuffle_hash"), docs["id"] == needed["node"], "left_semi").select("id", "text").mapInArrow(_pack_sets(size), "node long, members binary")
    left = sets.select(F.col("node").alias("u"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("v"), F.col("members").alias("right"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "left", "right").mapInArrow(_overlaps(num, den), "u long, v long").distinct()


def _list_pairs(num: int, den: int):
    """Candidate pairs of each n-gram's list; input sorted by n-gram within the task (and by block
    for lists that were dealt out)."""
    def pairs_of(node, comp, n, pos, prev, side) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of one list that position blocks and sizes do not rule out."""
        order = np.lexsort((n, pos))
        node, comp, n, pos, prev, side = (c[order] for c in (node, comp, n, pos, prev, side))
        starts = np.flatnonzero(np.concatenate([[True], pos[1:] != pos[:-1]]))
        ends = np.append(starts[1:], len(pos))
        us, vs = [], []
        for i in range(len(starts)):
            for j in range(i, len(starts)):
                bs, be = starts[j], ends[j]
                for a in range(starts[i], ends[i]):
                    # Sizes that a partner from this block can have: by length, then by the overlap
                    # left from both positions.
                    lo, hi = -(-num * n[a] // den), den * n[a] // num
                    s = max(bs, a + 1) if i == j else bs
                    at = np.arange(max(s, bs + np.searchsorted(n[bs:be], lo)), bs + np.searchsorted(n[bs:be], hi, side="right"))
                    if not len(at):
                        continue
                    best = 1 + np.minimum(n[a] - pos[a] - 1, n[at] - pos[at] - 1)
                    ok = (best * (den + num) >= num * (n[a] + n[at])) & (comp[at] != comp[a]) & ((prev[at] != prev[a]) | (prev[a] == 0)) & ((side[at] != side[a]) | (side[a] == 0))
                    if ok.any():
                        us.append(np.full(ok.sum(), node[a]))
                        vs.append(node[at[ok]])
        if not us:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(us), np.concatenate(vs)

    def lists(node, comp, n, pos, prev, side, first) -> tuple[np.ndarray, np.ndarray]:
        counts = np.diff(first)
        us, vs = [], []
        # Short lists, all at once: every pair of places i < j.
        short = np.flatnonzero((counts > 1) & (counts <= 32))
        if len(short):
            c = counts[short]
            total = c * (c - 1) // 2
            own = np.repeat(np.arange(len(short)), total)
            k = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
            j = ((1 + np.sqrt(1 + 8 * k)) / 2).astype(np.int64)
            j -= j * (j - 1) // 2 > k
            j += (j + 1) * j // 2 <= k
            i = k - j * (j - 1) // 2
            a, b = first[short][own] + i, first[short][own] + j
            best = 1 + np.minimum(n[a] - pos[a] - 1, n[b] - pos[b] - 1)
            ok = (comp[a] != comp[b]) & (best * (den + num) >= num * (n[a] + n[b])) & ((prev[a] != prev[b]) | (prev[a] == 0)) & ((side[a] != side[b]) | (side[a] == 0))
            ok &= (den * np.minimum(n[a], n[b]) >= num * np.maximum(n[a], n[b]))
            us.append(node[a[ok]])
            vs.append(node[b[ok]])
        for g in np.flatnonzero(counts > 32):
            at = slice(first[g], first[g + 1])
            if (comp[at] != comp[first[g]]).any():
                u, v = pairs_of(node[at], comp[at], n[at], pos[at], prev[at], side[at])
                us.append(u)
                vs.append(v)
        if not us:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        u, v = np.concatenate(us), np.concatenate(vs)
        both = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
        return both[:, 0], both[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        names = ["token", "block", "node", "comp", "n", "pos", "prev", "side"]
        empty = False
        batches = iter(batches)
        while not empty:
            batch = next(batches, None)
            empty = batch is None
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names] if not empty else [np.zeros(0, np.int64)] * len(names)
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols, strict=True)]
            token, block = cols[:2]
            if not len(token):
                continue
            change = np.flatnonzero((token[1:] != token[:-1]) | (block[1:] != block[:-1])) + 1
            cut = len(token) if empty else (int(change[-1]) if len(change) else 0)
            rest = [c[cut:] for c in cols]
            if cut:
                first = np.concatenate([[0], change[change < cut], [cut]])
                u, v = lists(*(c[:cut] for c in cols[2:]), first)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
    return run


def candidates(index: DataFrame, hot: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (u, v) across components that some list does not rule out. ``index`` and ``hot``:
    (token, node, comp, n, pos, prev); ``hot`` holds the lists that may be long."""
    zero = F.lit(0).cast("long")
    lists = index.withColumns({"block": zero, "side": zero})
    # Long lists: only those of several components, dealt out by pairs of blocks of bounded rows.
    sizes = hot.groupBy("token").agg(F.count("*").alias("rows"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(F.col("lo") < F.col("hi"))
    dealt = hot.join(sizes.select("token", F.ceil(F.col("rows") / HOT_LIST).cast("long").alias("blocks")), "token")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    dealt = dealt.select("token", "node", "comp", "n", "pos", "prev", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("block"),
                         F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).cast("long").alias("side"))
    lists = lists.unionByName(dealt)
    ordered = lists.repartition("token", "block").sortWithinPartitions("token", "block")
    return ordered.select("token", "block", "node", "comp", "n", "pos", "prev", "side").mapInArrow(_list_pairs(num, den), "u long, v long").distinct()


def join(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4, num: int = 85, den: int = 100,
         tables: Tables | None = None) -> DataFrame:
    """One row per row of ``df``: id, n_shingles, component_id (smallest id reachable by links)."""
    spark = df.sparkSession
    tables = tables or Tables(spark, "jaccard")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(Order(sketch(docs.select("text"), size)))
    sets = tables.put(docs.mapInArrow(_describe(shared, size, num, den), "id long, n long, d1 long, d2 long, prefix array<long>, hot array<boolean>, hashes array<long>, common long"), "sets")
    full = sets.where((F.col("n") > 0) & F.col("id").isNotNull())
    # One row per class: that of its smallest id.
    reps = tables.put(full.groupBy("d1", "d2").agg(F.min(F.struct("id", "n", "prefix", "hot", "hashes", "common")).alias("one"))
                      .select("d1", "d2", F.col("one.id").alias("node"), "one.n", "one.prefix", "one.hot", "one.hashes", "one.common"), "reps")
    classes = reps.select("d1", "d2", "node")

    # Near copies: of the classes that share each min-hash the one whose n-grams are the most frequent (an edit brings
    # rare ones, so it has the fewest edits of its group), by how many min-hashes they share with it in all.
    keys = reps.select("node", "n", "hashes", (-F.col("common")).alias("rare"), F.explode(F.array_distinct("hashes")).alias("key"))
    leaders = keys.groupBy("key").agg(F.min(F.struct("rare", "node", "n", "hashes")).alias("first"), F.count("*").alias("rows")).where(F.col("rows") > 1)
    near = keys.join(leaders, "key").where(F.col("node") != F.col("first.node"))
    shared_hashes = F.size(F.filter(F.sequence(F.lit(0), F.lit(MIN_HASHES - 1)), lambda k: F.get("hashes", k) == F.get("first.hashes", k)))
    near = near.where(F.least("n", "first.n") * den >= F.greatest("n", "first.n") * num).select("node", "first.rare", F.col("first.node").alias("leader"), shared_hashes.alias("hits"))
    near = near.where(F.col("hits") >= SHARED_HASHES).groupBy("node").agg(F.sort_array(F.collect_set(F.struct((-F.col("hits")).alias("hits"), "rare", "leader"))).alias("best"))
    near = near.select(F.col("node").alias("u"), F.explode(F.slice("best", 1, LEADERS)).alias("b")).select("u", F.col("b.leader").alias("v"))
    # An id in several classes joins them: its rows are one document.
    twice = full.groupBy("id").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    named = full.join(twice, "id", "left_semi").join(classes, ["d1", "d2"]).select("id", "node").distinct()
    same = named.join(named.groupBy("id").agg(F.min("node").alias("v")), "id").where(F.col("node") != F.col("v")).select(F.col("node").alias("u"), "v")
    near = tables.put(near, "near")
    links = tables.put(verified(near, docs, size, num, den).unionByName(same), "links")
    groups = components(links, tables)

    # All other links: pairs of different components whose prefixes meet.
    prefix = reps.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("comp"), "n", "prefix", "hot")
    rows = prefix.select("node", "comp", "n", "prefix", "hot", F.posexplode("prefix").alias("at", "token"))
    rows = rows.select("token", "node", "comp", "n", F.col("at").cast("long").alias("pos"), F.get("hot", F.col("at")).alias("hot"),
                       F.when(F.col("at") > 0, F.get("prefix", F.col("at") - 1)).otherwise(0).alias("prev"))
    cold, hot = rows.where(~F.col("hot")).drop("hot"), rows.where("hot").drop("hot")
    pairs = tables.put(candidates(cold, hot, num, den), "pairs")
    pairs = tables.put(possible(pairs, reps, shared, num, den), "possible")
    more = tables.put(verified(pairs, docs, size, num, den), "links")
    stars = groups.select(F.col("node").alias("u"), F.col("component").alias("v"))
    groups = components(stars.unionByName(more), tables)

    named = classes.join(groups, "node", "left").select("d1", "d2", F.coalesce("component", "node").alias("component_id"))
    got = sets.select("id", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    return tables.finish(got.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                    F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component_id"))).otherwise(F.col("id")).alias("component_id")))


def keep_one(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows (all columns) of one document of each component, that of the smallest id; rows with a null id stay.

    A document is an id with a text: rows of one id with different texts are different documents, judged each; rows
    that repeat both are one document and stay or go together. Its key is a hash of 63 bits of the two."""
    def free(name: str) -> str:
        while name in df.columns:
            name += "_"
        return name

    key, one = free("row_key"), free("kept_key")
    hashed = F.xxhash64(id_col, text_col, F.col(text_col).isNull()).bitwiseAND(F.lit(2**63 - 1))
    known = df.where(F.col(id_col).isNotNull()).withColumn(key, hashed)
    found = join(known, id_col=key, text_col=text_col, **kw).select(F.col(key).alias("row"), "component_id").distinct()
    rows = known.groupBy(F.col(key).alias("row")).agg(F.min(id_col).alias("id"))
    first = found.join(rows, "row").groupBy("component_id").agg(F.min(F.struct("id", "row")).alias("one"))
    kept = known.join(first.select(F.col("one.row").alias(one)), F.col(key) == F.col(one), "left_semi").select(*df.columns)
    return kept.unionByName(df.where(F.col(id_col).isNull()))
