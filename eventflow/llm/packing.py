"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

Each task packs the documents it scans, in groups of bounded tokens; nothing is shuffled. Whole
windows of a long document leave at once. The rest of a group is dealt over k windows: every piece
starts as a partial partition of its own, and the two partial partitions with the largest
imbalance merge, the fullest window of one with the emptiest of the other, until one is left,
whose windows are near-equal. With ``cut`` (a piece may be divided), k is the group's tokens over
the capacity, and the few tokens by which windows exceed it are cut off and fill the others;
the rest of a task, under one window, leaves in sequences of power-of-two lengths, so nothing is
padded. Without it pieces stay whole, and the window count rises whenever the capacity is exceeded.

Corner cases: null and empty texts consist of the end id; a text longer than the capacity is
divided; repeated rows are packed each; null ids are kept; an empty table gives no rows. Sequence
ids are unique, not gapless: the task's partition in the high bits.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from eventflow.llm import wordids

CAPACITY, GROUP_WINDOWS, END_ID = 4096, 128, 2
# Characters of the texts that are encoded together (a longer text alone).
ENCODED_CHARS = 250_000


def differencing(sizes: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each size, windows' sums) by Karmarkar-Karp differencing over ``k`` windows."""
    n = len(sizes)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(k, np.int64)
    # A partial partition: its sums, largest first, and how it came about.
    sums: dict[int, np.ndarray] = {}
    merged: list[tuple[int, int, np.ndarray]] = []
    heap = []
    for i, size in enumerate(sizes):
        own = np.zeros(k, np.int64)
        own[0] = size
        sums[i] = own
        heap.append((-size if k > 1 else 0, i))
    heapq.heapify(heap)
    for step in range(n - 1):
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joint = sums.pop(a) + sums.pop(b)[::-1]  # fullest with emptiest
        order = np.argsort(-joint, kind="stable")
        joint = joint[order]
        sums[n + step] = joint
        merged.append((a, b, order))
        heapq.heappush(heap, (int(joint[-1] - joint[0]), n + step))
    root = heap[0][1]
    window = np.zeros(n, np.int64)
    todo = [(root, np.arange(k))]
    while todo:
        node, label = todo.pop()  # label: the window of each of its sums
        if node < n:
            window[node] = label[0]
            continue
        a, b, order = merged[node - n]
        before = np.empty(k, np.int64)
        before[order] = label
        todo.append((a, before))
        todo.append((b, before[::-1]))
    return window, sums[root]


class Piece:
    """Tokens ``start`` to ``start + length`` of a document."""

    __slots__ = ("doc", "start", "length")

    def __init__(self, doc: tuple, start: int, length: int):
        self.doc, self.start, self.length = doc, start, length

    def cut(self, length: int) -> Piece:
        """Keeps ``length`` tokens; the rest is returned."""
        rest = Piece(self.doc, self.start + length, self.length - length)
        self.length = length
        return rest


def level(windows: list[list[Piece]], capacity: int) -> None:
    """Cut what exceeds the capacity off the largest pieces; it fills the other windows."""
    over, room = [], []
    for w in windows:
        total = sum(p.length for p in w)
        while total > capacity:
            p = max(w, key=lambda x: x.length)
            extra = min(total - capacity, p.length)
            total -= extra
            if extra == p.length:
                w.remove(p)
                over.append(p)
            else:
                over.append(p.cut(p.length - extra))
        if total < capacity:
            room.append((capacity - total, w))
    room.sort(key=lambda r: -r[0])
    at = 0
    for p in sorted(over, key=lambda p: -p.length):
        while True:
            free, w = room[at]
            if p.length <= free:
                w.append(p)
                room[at] = (free - p.length, w)
                if p.length == free:
                    at += 1
                break
            rest = p.cut(free)
            w.append(p)
            at += 1
            p = rest


def pack_group(pieces: list[Piece], capacity: int, cut: bool) -> list[list[Piece]]:
    """Windows of at most ``capacity`` tokens over all pieces, by differencing."""
    total = sum(p.length for p in pieces)
    k = -(-total // capacity)
    while True:
        window, sums = differencing([p.length for p in pieces], k)
        if cut or sums[0] <= capacity:
            break
        k += 1
    out: list[list[Piece]] = [[] for _ in range(k)]
    for p, w in zip(pieces, window, strict=True):
        out[w].append(p)
    if cut and sums[0] > capacity:
        level(out, capacity)
    return [w for w in out if w]


def powers_of_two(pieces: list[Piece], total: int) -> list[list[Piece]]:
    """Pieces of fewer tokens than a window, in sequences whose lengths are powers of two."""
    out, pieces = [], pieces[::-1]
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        w: list[Piece] = []
        while room:
            p = pieces.pop()
            if p.length > room:
                pieces.append(p.cut(room))
            room -= p.length
            w.append(p)
        out.append(w)
    return out


class Packer:
    """Packs a stream of documents; ``rows`` gathers the pieces of finished windows."""

    def __init__(self, capacity: int, group_windows: int, cut: bool, first_id: int):
        self.capacity, self.cut, self.next_id = capacity, cut, first_id
        self.limit = capacity * group_windows
        self.pool: list[Piece] = []
        self.tokens = 0
        self.rows: list[tuple] = []

    def emit(self, windows: list[list[Piece]]) -> None:
        for w in windows:
            offset = 0
            for p in w:
                doc_id, ids = p.doc
                own = memoryview(ids)[4 * p.start:4 * (p.start + p.length)]
                self.rows.append((doc_id, p.start, p.length, zlib.crc32(own), len(ids) // 4, self.next_id, offset))
                offset += p.length
            self.next_id += 1

    def add(self, doc_id, ids: bytes) -> None:
        doc, n = (doc_id, ids), len(ids) // 4
        whole = n // self.capacity * self.capacity
        self.emit([[Piece(doc, at, self.capacity)] for at in range(0, whole, self.capacity)])
        if n == whole:
            return
        piece = Piece(doc, whole, n - whole)
        self.pool.append(piece)
        self.tokens += piece.length
        if self.tokens >= self.limit:
            rest = []
            if self.cut and self.tokens > self.limit:
                rest = [piece.cut(piece.length - (self.tokens - self.limit))]
            self.emit(pack_group(self.pool, self.capacity, self.cut))
            self.pool, self.tokens = rest, sum(p.length for p in rest)

    def close(self) -> None:
        pool, tokens = self.pool, self.tokens
        self.pool, self.tokens = [], 0
        if not self.cut:
            self.emit(pack_group(pool, self.capacity, False) if pool else [])
            return
        # The last pieces are set aside until whole windows remain.
        aside, spare = [], tokens % self.capacity
        left = spare
        while left:
            p = pool.pop()
            if p.length > left:
                aside.append(p.cut(p.length - left))
                pool.append(p)
                break
            left -= p.length
            aside.append(p)
        if pool:
            self.emit(pack_group(pool, self.capacity, True))
        self.emit(powers_of_two(aside, spare))


def _together(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """(id, text) of consecutive rows, as many as are encoded together."""
    docs, chars = [], 0
    for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
        text = value.as_py() or ""
        if docs and chars + len(text) > ENCODED_CHARS:
            yield docs
            docs, chars = [], 0
        docs.append((doc_id.as_py(), text))
        chars += len(text)
    if docs:
        yield docs


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         group_windows: int = GROUP_WINDOWS, end_id: int = END_ID, cut: bool = True, kept_words: int = wordids.KEPT_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``kept_words``: words whose ids a worker keeps, about (memory against time)."""
    kind = df.select(id_col).schema[0].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = wordids.load(path)
        packer = Packer(capacity, group_windows, cut, TaskContext.get().partitionId() << 32)
        id_type = None

        def rows() -> Iterator[pa.RecordBatch]:
            if packer.rows:
                columns = list(zip(*packer.rows, strict=True))
                packer.rows = []
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        for batch in batches:
            id_type = batch.column(0).type
            for docs in _together(batch):
                for (doc_id, _), ids in zip(docs, encoder.encode_all([text for _, text in docs], kept_words), strict=True):
                    packer.add(doc_id, ids + end)
            yield from rows()
        packer.close()
        yield from rows()

    return df.select(df[id_col], df[text_col]).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
