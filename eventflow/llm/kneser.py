"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

*Counting.* A task cuts its texts into tokens and counts the distinct n-grams of a block; an n-gram is its last
word's hash and the hashes of the 1 to n-1 words before it (64 bits each). A row is a history with the words
after it and their counts, as packed arrays. Rows go to shards of the history's hash; words that hold a large share of the tokens (found on a sample, which only decides the placement) have
the n-grams behind them spread over ``SPREAD`` shards. A task adds up one shard at a time, writes its n-grams as
a sorted array of hashes and an array of counts, and hands on: per history the total and how many n-grams
occur once, twice, more often; per word its count; and the next shorter n-grams, whose count is the number of
words seen before them (their own count where they begin a text). A last pass writes the same kind of arrays
for histories and words. Only counts of counts and totals, some dozen figures, come to the driver.

*Model.* With D(c) the three discounts of an order, from its counts of counts (n1 to n4):
``p(w|h) = max(c(hw) - D(c), 0) / total(h) + gamma(h) * p(w|h')``; an unseen history leaves ``p(w|h')``; words
end in a uniform share of 1 / (V + 1), which an unknown word gets. It sums to 1 over the vocabulary, the end of
the text, and one unknown word.

*Scoring.* Workers map the arrays from the shared folder and look up the distinct n-grams of a block of texts in
sorted order; nothing of the model is sent, and a mapped page is shared by the workers of a machine. The shared
folder must therefore be a path on the executors (a mount); any other is refused.

Results are exact up to collisions of 64-bit hashes. The model and the table made from it grow with the input;
a task holds one block of texts or one shard (``SHARD_BYTES`` of text on average).

Corner cases: a null text is an empty one (one token, its end); a null id counts as an empty text where the fold
is drawn; repeated rows are learnt and scored as often as they occur; texts of any length are read whole (a
text longer than a block is a block of its own); other columns are not read; with nothing to learn from, every
probability is 1 / (V + 1) = 1; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.shared import Tables

#: Two words. The query's order: three words come to more than four times the input on disk (README).
ORDER = 2
#: Bytes of text a shard has on average, and the least number of shards as a power of two.
SHARD_BYTES, LEAST_BITS = 8 << 20, 6
#: Bytes of text counted, and scored, at a time.
BLOCK_BYTES, SCORE_BYTES = 16 << 20, 6 << 20
#: The share of a sample's tokens from which on a word is spread, and over how many shards.
HOT_SHARE, SAMPLE, SPREAD = 1 / 256, 0.01, 64
OUT_ROWS = 100_000
#: Words whose figures a task holds before it hands them on.
HELD_WORDS = 1 << 21

U = np.uint64
#: Hashes of the marks before and after a text.
BEGIN, END = U(0x8C6F1B3D5A7E9124), U(0x3E19D7A4C25B806F)
_ODD = U(0x9E3779B97F4A7C15)
GRAM, HISTORY, WORD, COUNTS = range(4)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers whose high bits depend on all bits."""
    x = (x ^ (x >> U(31))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xCA9B21E6A94F3D6B)
    return x ^ (x >> U(32))


def gram_key(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(history) + word * _ODD)


@dataclass
class Placing:
    """Where hashes are kept: shards of the high bits; behind spread words also by the n-gram's last word."""

    bits: int
    hot: np.ndarray

    def of(self, key: np.ndarray) -> np.ndarray:
        return (mix(key + _ODD) >> U(64 - self.bits)).astype(np.int32)

    def of_gram(self, history: np.ndarray, last: np.ndarray, word: np.ndarray) -> np.ndarray:
        """``last``: the hash of the word before."""
        salt = (mix(word) % U(SPREAD) + U(1)) * np.isin(last, self.hot) if len(self.hot) else U(0)
        return self.of(history + salt * _ODD)


@dataclass
class Block:
    """The tokens of some texts: hashes, each with its place in its text, and where texts start."""

    ids: np.ndarray
    place: np.ndarray
    starts: np.ndarray

    def histories(self, longest: int) -> list[np.ndarray]:
        """Hashes of the 1, 2, ... words before each token; before the text stand marks."""
        out: list[np.ndarray] = []
        for m in range(1, longest + 1):
            back = np.full(len(self.ids), BEGIN)
            back[m:] = self.ids[:-m] if m < len(self.ids) else self.ids[:0]
            back[self.place < m] = BEGIN
            out.append(back if m == 1 else mix(out[-1] + back * _ODD + U(m)))
        return out


def word_hashes(words: pa.Array) -> np.ndarray:
    import pandas as pd

    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False) if len(words) else np.zeros(0, U)


def tokens(texts: pa.Array) -> Block:
    """Lower-cased (A-Z) words between ASCII white space, and one end after each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    sizes = np.diff(before[offsets]) + 1
    coded = flat.filter(pa.array(real)).dictionary_encode()
    ends = np.cumsum(sizes) - 1
    ids = np.full(int(sizes.sum()), END)
    inner = np.ones(len(ids), bool)
    inner[ends] = False
    ids[inner] = word_hashes(coded.dictionary)[coded.indices.to_numpy()]
    starts = ends - sizes + 1
    return Block(ids, np.arange(len(ids)) - np.repeat(starts, sizes), starts)


def blocks(batch: pa.RecordBatch, column: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most`` (else BLOCK_BYTES) bytes of text, or one text."""
    most = most or BLOCK_BYTES
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    lo = total = 0
    for i, s in enumerate(sizes):
        if i > lo and total + s > most:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += s
    if lo < batch.num_rows:
        yield batch.slice(lo)


def _rows(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    size = len(next(iter(columns.values())))
    for lo in range(0, size, OUT_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + OUT_ROWS].view(np.int64) if c.dtype == U else c[lo:lo + OUT_ROWS]) for c in columns.values()], list(columns))


def _packed(shard: np.ndarray, histories: list[np.ndarray], lead: np.ndarray, w: np.ndarray, c: np.ndarray) -> pa.Table:
    """N-grams as rows of a history (in a shard): its own columns once, its words and their counts as arrays."""
    at = np.lexsort((histories[-1], shard))
    shard, top, w, c = shard[at], histories[-1][at], np.ascontiguousarray(w[at]), np.ascontiguousarray(c[at])
    first = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (top[1:] != top[:-1])])) if len(w) else np.zeros(0, np.int64)
    cuts = np.append(first, len(w))

    def binary(a):
        return pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((cuts * a.itemsize).astype(np.int32)), pa.py_buffer(a)])

    rows = at[first]
    return pa.table({"shard": pa.array(shard[first]), "words": binary(w), "counts": binary(c), "lead": pa.array(lead[rows]),
                     **{f"h{m + 1}": pa.array(h[rows].view(np.int64)) for m, h in enumerate(histories)}})


def _unpacked(t: pa.Table, level: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Per n-gram: the hashes of its histories, lead, word, count."""
    def flat(name):
        bodies, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
        for chunk in t.column(name).chunks:
            cuts = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
            bodies.append(np.frombuffer(chunk.buffers()[2], np.uint8)[cuts[0]:cuts[-1]])
            sizes.append(np.diff(cuts))
        return np.concatenate(bodies), np.concatenate(sizes)

    w, sizes = flat("words")
    sizes = sizes // 8
    w = w.view(U)
    c, _ = flat("counts")
    c = c.view(f"u{max(len(c) // max(len(w), 1), 1)}").astype(np.int64)
    return [np.repeat(t.column(f"h{m}").to_numpy().view(U), sizes) for m in range(1, level)], np.repeat(t.column("lead").to_numpy(), sizes), w, c


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows that come sorted by their first column, ``shard``, one shard at a time."""
    held: list[pa.RecordBatch] = []

    def close():
        return pa.Table.from_batches(held)

    for b in batches:
        shards = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi > lo:
                if held and held[0].column(0)[0].as_py() != shards[lo]:
                    yield held[0].column(0)[0].as_py(), close()
                    held = []
                held.append(b.slice(lo, hi - lo))
    if held:
        yield held[0].column(0)[0].as_py(), close()


# ------------------------------------------------------------------ arrays on disk
def _path(root: str, kind: int, level: int, shard: int, name: str) -> str:
    return f"{root}/{kind}-{level}-{shard:08x}.{name}"


def _write(root: str, kind: int, level: int, shard: int, arrays: dict[str, np.ndarray]) -> None:
    """Whole files appear at once, so that a task that is run again, or twice, does no harm."""
    for name, a in arrays.items():
        a = a if name == "key" else a.astype(np.min_scalar_type(int(a.max(initial=0))))
        path = _path(root, kind, level, shard, f"{name}.{a.dtype.str[1:]}")
        own = f"{path}.{uuid.uuid4().hex}"
        with open(own, "wb") as f:
            a.tofile(f)
        os.replace(own, path)


class Arrays:
    """The arrays of a model. One shard is mapped at a time, so that what a worker maps does not grow with the model."""

    def __init__(self, root: str):
        self.root = root

    def get(self, kind: int, level: int, shard: int, name: str) -> np.ndarray:
        for dtype in ("u8",) if name == "key" else ("u1", "u2", "u4", "u8"):
            path = _path(self.root, kind, level, shard, f"{name}.{dtype}")
            if os.path.exists(path) and os.path.getsize(path):
                return np.memmap(path, dtype, "r")
        return np.zeros(0, U)

    def look_up(self, kind: int, level: int, shards: np.ndarray, keys: np.ndarray, names: list[str]) -> list[np.ndarray]:
        """The values of sorted ``keys``; 0 for those that are not there."""
        out = [np.zeros(len(keys), np.int64) for _ in names]
        order = np.argsort(shards, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(shards[order])) + 1, [len(keys)]]) if len(keys) else [0]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            mine = order[lo:hi]
            shard = int(shards[mine[0]])
            known = self.get(kind, level, shard, "key")
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
            hit = known[at] == keys[mine]
            for o, name in zip(out, names):
                o[mine[hit]] = self.get(kind, level, shard, name)[at[hit]]
        return out


# ------------------------------------------------------------------ counting
def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys, sorted, and each value's sums."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order].astype(np.int64), first) if len(keys) else v[:0] for v in values)


def _count_grams(order: int, placing: Placing):
    """Texts to packed n-grams. ``lead``: the marks at an n-gram's start."""
    def run(batches):
        for batch in batches:
            for part in blocks(batch, 0):
                b = tokens(part.column(0))
                h = b.histories(order - 1)
                _, at, c = np.unique(gram_key(h[-1], b.ids), return_index=True, return_counts=True)
                h, w = [x[at] for x in h], b.ids[at]
                lead = np.maximum(order - 1 - b.place[at], 0).astype(np.int8)
                yield from _packed(placing.of_gram(h[-1], h[0], w), h, lead, w, c.astype(np.uint32)).to_batches(OUT_ROWS)
    return run


def _gram_schema(level: int) -> str:
    return "shard int, words binary, counts binary, lead byte" + "".join(f", h{m} long" for m in range(1, level))


STATS = "shard int, kind byte, level byte, key long, a long, b long, c long, d long"


def _stats(shard: np.ndarray, kind: int, level: int, key: np.ndarray, *values: np.ndarray) -> dict[str, np.ndarray]:
    none = np.zeros(len(key), np.int64)
    return {"shard": shard, "kind": np.full(len(key), kind, np.int8), "level": np.full(len(key), level, np.int8), "key": key,
            **{n: (values[i].astype(np.int64) if i < len(values) else none) for i, n in enumerate("abcd")}}


def _times(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return c == 1, c == 2, c >= 3


def _counts_of_counts(shard: int, level: int, c: np.ndarray) -> dict[str, np.ndarray]:
    """Per count 1 to 4 how many have it (key 0: the sum of counts, key 5: how many there are)."""
    figures = [int(c.sum()), *((c == k).sum() for k in (1, 2, 3, 4)), len(c)]
    return _stats(np.full(6, shard, np.int32), COUNTS, level, np.arange(6), np.array(figures, np.int64))


def _add_up(level: int, order: int, placing: Placing, root: str):
    """Packed n-grams of one level, sorted by shard: arrays written; figures and (above 2) shorter n-grams given."""
    longer = [f"h{m}" for m in range(1, level - 1)]
    names = [f.split()[0] for f in STATS.split(", ")]

    def figures(columns):
        for b in _rows(columns):
            none = {"words": pa.nulls(len(b), pa.binary()), "counts": pa.nulls(len(b), pa.binary()), "lead": pa.nulls(len(b), pa.int8()),
                    **{m: pa.nulls(len(b), pa.int64()) for m in longer}}
            yield b if level == 2 else pa.RecordBatch.from_arrays([*b.columns, *none.values()], [*names, *none])

    def of_words(held):
        key, raw, left = _sums(*(np.concatenate(x) for x in zip(*held)))
        return key, raw, left

    def run(batches):
        held, size = [], 0  # figures of words, of the task's shards so far
        for shard, t in _groups(batches):
            h, lead, w, c = _unpacked(t, level)
            keys = gram_key(h[-1], w)
            at = np.argsort(keys)
            first = np.concatenate([[True], keys[at][1:] != keys[at][:-1]])
            c = np.add.reduceat(c[at], np.flatnonzero(first))
            at = at[first]
            h, lead, w = [x[at] for x in h], lead[at], w[at]
            _write(root, GRAM, level, shard, {"key": keys[at], "n": c})
            hk, total, n1, n2, n3 = _sums(h[-1], c, *_times(c))
            yield from figures(_stats(placing.of(hk), HISTORY, level, hk, total, n1, n2, n3))
            yield from figures(_counts_of_counts(shard, level, c))
            if level == order or level == 2:
                held.append(_sums(w, c if level == order else c * 0, np.full(len(c), int(level == 2))))
                size += len(held[-1][0])
                if size > HELD_WORDS:
                    held = [of_words(held)]
                    size = len(held[0][0])
                    if size > HELD_WORDS // 2:
                        yield from figures(_stats(placing.of(held[0][0]), WORD, 1, *held[0]))
                        held, size = [], 0
            if level > 2:
                rest = h[:-1]
                shorter = _packed(placing.of_gram(rest[-1], rest[0], w), rest, np.maximum(lead - 1, 0).astype(np.int8), w,
                                  np.where(lead >= 2, c, 1).astype(np.uint64))
                for b in shorter.to_batches(OUT_ROWS):
                    none = [pa.nulls(len(b), pa.int8()) if n in ("kind", "level") else pa.nulls(len(b), pa.int64()) for n in names[1:]]
                    yield pa.RecordBatch.from_arrays([b.column(0), *none, *b.columns[1:]], [*names, *b.schema.names[1:]])
        if held:
            done = of_words(held)
            yield from figures(_stats(placing.of(done[0]), WORD, 1, *done))
    return run


def _finish(root: str):
    """Figures of histories and words, sorted by shard: arrays written, counts of counts given."""
    def run(batches):
        for shard, t in _groups(batches):
            t = {n: t.column(n).to_numpy() for n in t.column_names}
            for kind in (HISTORY, WORD, COUNTS):
                for level in np.unique(t["level"][t["kind"] == kind]).tolist():
                    mine = (t["kind"] == kind) & (t["level"] == level)
                    key, a, b, c, d = _sums(t["key"][mine].view(U), *(t[n][mine] for n in "abcd"))
                    if kind == HISTORY:
                        _write(root, HISTORY, level, shard, {"key": key, "total": a, "n1": b, "n2": c, "n3": d})
                    elif kind == WORD:
                        _write(root, WORD, level, shard, {"key": key, "n": a, "left": b})
                        yield from _rows(_counts_of_counts(shard, 1, b))
                        yield from _rows(_counts_of_counts(shard, 0, a))
                    else:
                        yield from _rows(_stats(np.full(len(key), shard, np.int32), COUNTS, level, key, a))
    return run


def _hot_words(texts: DataFrame) -> np.ndarray:
    """Words behind which n-grams are spread. At most 1 / HOT_SHARE; a wrong guess costs time, not results."""
    def run(batches):
        for batch in batches:
            for part in blocks(batch, 0):
                ids = tokens(part.column(0)).ids
                key, n = np.unique(ids, return_counts=True)
                often = n >= len(ids) * HOT_SHARE / 2
                yield from _rows({"key": np.concatenate([key[often], [U(0)]]), "n": np.concatenate([n[often], [len(ids)]])})

    got = texts.sample(False, SAMPLE, 7).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in got if r["key"] == 0)
    return np.array(sorted(r["key"] for r in got if r["key"] and r["n"] >= total * HOT_SHARE), np.int64).view(U)


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """D(1), D(2), D(3 and more) from how many n-grams occur 1, 2, 3 and 4 times; halves where these say nothing."""
    n1, n2, n3, n4 = counts
    out = []
    for k, (here, more) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * (n1 / (n1 + 2 * n2)) * more / here if here and n1 + 2 * n2 else 0.0
        out.append(d if 0 < d <= k else k / 2)
    return tuple(out)


@dataclass
class Model:
    """A model on disk. ``tokens`` and ``words``: N and V of the training texts, ends included; ``discounts`` and
    ``figures`` (counts 1 to 4, number, total) by order."""

    root: str
    order: int
    placing: Placing
    tokens: int
    words: int
    figures: dict[int, list[int]] = field(default_factory=dict)
    discounts: dict[int, tuple[float, float, float]] = field(default_factory=dict)


def mounted(path: str) -> str:
    """The folder as a path of this machine and the executors."""
    where = urlparse(path)
    if where.scheme not in ("", "file"):
        raise RuntimeError(f"models are mapped by workers: spark.checkpoint.dir must be a mounted folder, not {path}")
    return where.path


def train(texts: DataFrame, tables: Tables, order: int = ORDER) -> Model:
    """Learns from all rows of ``texts`` (one string column); the arrays go to the folder of ``tables``."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    texts = texts.toDF("text")
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).head()["n"] or 0
    placing = Placing(max(LEAST_BITS, (size // SHARD_BYTES).bit_length()), _hot_words(texts))
    root = f"{mounted(tables.root)}/model"
    os.makedirs(root, exist_ok=True)
    grams = texts.mapInArrow(_count_grams(order, placing), _gram_schema(order))
    parts = []
    for level in range(order, 1, -1):
        longer = [f"h{m}" for m in range(1, level - 1)]
        schema = STATS if level == 2 else f"{STATS}, {_gram_schema(level - 1).split(', ', 1)[1]}"
        out = grams.repartition("shard").sortWithinPartitions("shard").mapInArrow(_add_up(level, order, placing, root), schema)
        if level > 2:
            out = tables.put(out, f"level{level}")
            grams = out.where(F.col("kind").isNull()).select("shard", "words", "counts", "lead", *longer)
            out = out.where(F.col("kind").isNotNull()).select(*[f.split()[0] for f in STATS.split(", ")])
        parts.append(out)
    stats = parts[0]
    for p in parts[1:]:
        stats = stats.unionByName(p)
    last = stats.repartition("shard").sortWithinPartitions("shard").mapInArrow(_finish(root), STATS)
    figures = {level: [0] * 6 for level in range(order + 1)}
    for r in last.groupBy("level", "key").agg(F.sum("a").alias("n")).collect():
        figures[r["level"]][r["key"]] = r["n"]
    return Model(root, order, placing, figures[0][0], figures[0][5], figures, {k: discounts(figures[k][1:5]) for k in range(1, order + 1)})


# ------------------------------------------------------------------ scoring
def _less(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3)], 0.0)


def probabilities(b: Block, model: Model, arrays: Arrays) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: the model's probability, the token's count in training, the smoothed unigram share."""
    word, back = np.unique(b.ids, return_inverse=True)
    n, left = arrays.look_up(WORD, 1, model.placing.of(word), word, ["n", "left"])
    total, d = model.figures[1][0], model.discounts[1]
    n1, n2 = model.figures[1][1:3]
    rest = model.figures[1][5] - n1 - n2
    uniform = 1 / (model.words + 1)
    p = (_less(left, d) / total + (d[0] * n1 + d[1] * n2 + d[2] * rest) / total * uniform if total else np.full(len(word), uniform))[back]
    for level, h in enumerate(b.histories(model.order - 1), 2):
        d = model.discounts[level]
        key, at, inverse = np.unique(gram_key(h, b.ids), return_index=True, return_inverse=True)
        last = h[at] if level == 2 else b.histories(1)[0][at]
        c, = arrays.look_up(GRAM, level, model.placing.of_gram(h[at], last, b.ids[at]), key, ["n"])
        own = _less(c, d)[inverse]
        key, inverse = np.unique(h, return_inverse=True)
        total, n1, n2, n3 = arrays.look_up(HISTORY, level, model.placing.of(key), key, ["total", "n1", "n2", "n3"])
        seen = np.maximum(total, 1)
        gamma = np.where(total > 0, (d[0] * n1 + d[1] * n2 + d[2] * n3) / seen, 1.0)
        p = own / seen[inverse] + gamma[inverse] * p
    return p, n[back], ((n + 0.5) / (model.tokens + 0.5 * (model.words + 1)))[back]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, n_tokens, n_known, base_score, score (log10) and perplexity."""
    def run(batches):
        arrays = Arrays(model.root)
        for batch in batches:
            for part in blocks(batch, 1, min(SCORE_BYTES, BLOCK_BYTES)):
                b = tokens(part.column(1))
                p, n, base = probabilities(b, model, arrays)
                size = np.diff(np.append(b.starts, len(b.ids)))
                total = np.add.reduceat(np.log10(p), b.starts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size.astype(np.int64)), pa.array(np.add.reduceat((n > 0).astype(np.int64), b.starts)),
                     pa.array(np.add.reduceat(np.log10(base), b.starts)), pa.array(total), pa.array(10.0 ** np.minimum(-total / size, 300.0))],
                    ["id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, n_tokens long, n_known long, base_score double, score double, perplexity double")
    return out.withColumnRenamed("id", id_col)


def learn_and_score(docs: DataFrame, held_out, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from the rows that the condition ``held_out`` leaves, and scores all rows."""
    tables = Tables(docs.sparkSession, "kneser")
    try:
        model = train(docs.where(~held_out).select(text_col), tables, order)
        out = score(docs, model, id_col, text_col).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
        return tables.finish(out)
    except BaseException:
        tables.drop()
        raise
