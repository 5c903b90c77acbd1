"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap checks.

The test items form an inverted index over word hashes, with BM25 impacts, the largest impact of
every term, and the largest impact per term and block of items. Each training text is cut into
overlapping passages and every passage is a query: it is passed over when the sum of its terms' largest
impacts cannot reach a threshold (the WAND bound); for the rest the blocks' largest impacts are
summed, and only items of blocks that can still reach their threshold are scored. An item is
retrieved by a passage that scores at least ``RETRIEVE`` of what the item's own text would score.
Retrieved pairs are verified on the whole text: the item's question (all but its last sentence)
and answer (its last sentence) are held when enough of their word 5-grams occur in the text; a part of fewer
than five words is held when its whole word sequence occurs in or beside a passage that retrieved the item.

A passage holds at least as many words as the longest item plus the step between passages, so an
item copied into a text lies whole in one passage. The index is sent to every task after a check
of its size; beyond ``MAX_INDEX_WORDS`` the items are handled in groups of that size, one scan each.

Corner cases: null and empty texts and items without words match nothing; items shorter than five
words are held where their words occur in a row; repeated items are reported under each id, repeated rows each; null
ids are kept; empty tables give no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.textscan import Words, chunks, text_buffers

K1, B = 1.2, 0.75
SHINGLE = 5
RETRIEVE, CONTAINED = 0.7, 0.8
BLOCK_ITEMS = 8
# Words of the items of one index, at most (about 50 bytes each in every task).
MAX_INDEX_WORDS = 2_000_000


def _answer_start(text: str) -> int:
    """Where an item's last sentence starts (its answer); 0 for a single sentence."""
    body = text.rstrip()
    at = max(body.rfind(". ", 0, -1), body.rfind("\n", 0, -1), body.rfind("? ", 0, -1), body.rfind("! ", 0, -1))
    return at + 1 if at >= 0 else 0


def _scan(texts: list[str]) -> Words:
    data, offsets = text_buffers(pa.array(texts, pa.large_string()))
    return Words(data, offsets)


def _parts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Each text's set of shingles and, when it has fewer words than a shingle, its words' hashes."""
    w = _scan(texts)
    words = [w.hash[w.first[i]:w.first[i + 1]] for i in range(len(texts))]
    return [(s, x if len(x) < SHINGLE else None) for s, x in zip(w.shingle_sets(SHINGLE), words, strict=True)]


class Index:
    """BM25 impacts of items' terms, with the bounds that WAND needs; items in blocks."""

    def __init__(self, items: list[tuple[int, str]]):
        items = sorted((i for i in items if i[1] and i[1].split()), key=lambda i: (len(i[1].split()), i[0] is None, i[0] or 0, i[1]))
        self.ids = [i for i, _ in items]
        texts = [t for _, t in items]
        cut = [_answer_start(t) for t in texts]
        self.question = _parts([t[:c] if c else t for t, c in zip(texts, cut, strict=True)])
        self.answer = _parts([t[c:] for t, c in zip(texts, cut, strict=True)])
        self.whole = _parts(texts)
        w = _scan(texts)
        n = len(texts)
        lengths = np.bincount(w.row, minlength=n) if n else np.zeros(0)
        self.longest = int(lengths.max()) if n else 0
        key, freq = np.unique(np.stack([w.hash.view(np.int64), w.row]), axis=1, return_counts=True)
        terms, self.term_of, df = np.unique(key[0], return_inverse=True, return_counts=True)
        order = np.argsort(terms.view(np.uint64))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.terms = terms.view(np.uint64)[order]
        self.term_of = place[self.term_of]
        df = df[order]
        self.item_of = key[1]
        mean = max(1.0, lengths.mean()) if n else 1.0
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        tf = freq * (K1 + 1) / (freq + K1 * (1 - B + B * lengths[self.item_of] / mean))
        impact = idf[self.term_of] * tf
        got = np.lexsort((self.item_of, self.term_of))
        self.term_of, self.item_of, self.impact = self.term_of[got], self.item_of[got], impact[got]
        self.first = np.searchsorted(self.term_of, np.arange(len(self.terms) + 1))
        self.own = np.bincount(self.item_of, self.impact, minlength=n)
        self.threshold = RETRIEVE * self.own
        self.largest = np.zeros(len(self.terms))
        np.maximum.at(self.largest, self.term_of, self.impact)
        # Largest impact of each term per block of items, as lists of (block, impact).
        block = self.item_of // BLOCK_ITEMS
        pair, inverse = np.unique(np.stack([self.term_of, block]), axis=1, return_inverse=True)
        self.block_of = pair[1]
        self.block_impact = np.zeros(pair.shape[1])
        np.maximum.at(self.block_impact, inverse.ravel(), self.impact)
        self.block_first = np.searchsorted(pair[0], np.arange(len(self.terms) + 1))
        self.blocks = -(-n // BLOCK_ITEMS)
        # The least score any item (or any item of a block) needs.
        self.least = self.threshold.min() if n else np.inf
        self.block_least = np.array([self.threshold[b * BLOCK_ITEMS:(b + 1) * BLOCK_ITEMS].min() for b in range(self.blocks)])
        # Common terms: those of least impact, whose impacts together stay under a third of what any
        # block needs. A passage's other terms must reach the rest by themselves.
        small = np.argsort(self.largest, kind="stable")
        together, n_common = np.zeros(self.blocks), 0
        for t in small:
            at = slice(self.block_first[t], self.block_first[t + 1])
            more = together[self.block_of[at]] + self.block_impact[at]
            if (more >= self.block_least[self.block_of[at]] / 3).any():
                break
            together[self.block_of[at]] = more
            n_common += 1
        self.block_rest = self.block_least - together
        rare = np.ones(len(self.terms), dtype=bool)
        rare[small[:n_common]] = False
        self.rare = np.flatnonzero(rare)
        # A table over the hashes' top bits spares most words a binary search.
        self.top = np.zeros(1 << 20, dtype=bool)
        self.top[self.terms[self.rare] >> np.uint64(44)] = True

    def lookup_rare(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``hashes``, term) of the words that are terms and not common."""
        at = np.flatnonzero(self.top[hashes >> np.uint64(44)])
        term, same = self._find(hashes[at], self.rare)
        return at[same], term

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The distinct terms among the words."""
        return np.unique(self._find(hashes, np.arange(len(self.terms)))[0])

    def _find(self, hashes: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(among) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(len(hashes), dtype=bool)
        place = np.minimum(np.searchsorted(self.terms[among], hashes), len(among) - 1)
        same = self.terms[among[place]] == hashes
        return among[place[same]], same

    def blocks_reached(self, passage: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The (passage, block) pairs whose block's largest impacts, summed over the passage's
        distinct rare terms, can reach what the block's items need."""
        at, own = _spread(self.block_first, term)
        bound = np.bincount(passage[own] * self.blocks + self.block_of[at], self.block_impact[at], minlength=n * self.blocks)
        hot = np.flatnonzero(bound.reshape(n, self.blocks) >= self.block_rest)
        return hot // self.blocks, hot % self.blocks

    def search(self, passage: np.ndarray, blocks: np.ndarray) -> list[tuple[int, float]]:
        """(item, score) of the blocks' items whose score for a passage's distinct terms reaches theirs."""
        at, _ = _spread(self.first, passage)
        hot = np.zeros(self.blocks, dtype=bool)
        hot[blocks] = True
        at = at[hot[self.item_of[at] // BLOCK_ITEMS]]
        score = np.bincount(self.item_of[at], self.impact[at], minlength=len(self.own))
        return [(int(i), float(score[i])) for i in np.flatnonzero((score >= self.threshold) & (score > 0))]


def _spread(first: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Postings first[k] to first[k + 1] of every key, and the key's place of each."""
    counts = first[keys + 1] - first[keys]
    own = np.repeat(np.arange(len(keys)), counts)
    return np.arange(counts.sum()) + (first[keys] - np.cumsum(counts) + counts)[own], own


def _share(part: tuple[np.ndarray, np.ndarray | None], text: np.ndarray, around: list[np.ndarray]) -> float:
    """How much of a part is held: of its shingles in the text's, or (short parts) whether its words are in a
    row in one of the stretches ``around`` the passages."""
    shingles, words = part
    if words is not None:
        return float(len(words) > 0 and any(_in_a_row(words, a) for a in around))
    return float(np.isin(shingles, text, assume_unique=True).mean()) if len(shingles) else 0.0


def _in_a_row(words: np.ndarray, text: np.ndarray) -> bool:
    n = len(text) - len(words) + 1
    found = np.ones(max(n, 0), dtype=bool)
    for j in range(len(words) if n > 0 else 0):
        found &= text[j:j + n] == words[j]
    return bool(found.any())


def scan(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, float, float, float]]:
    """(row, item, score, shares of question, answer and whole item held) of a chunk's retrieved
    pairs; the score is the best passage's, over what the item's own text would score."""
    w = Words(data, offsets)
    if not len(w.hash) or not len(index.ids):
        return []
    step = max(32, index.longest)
    width = index.longest + step
    # Passages start every `step` words of a row; only their terms that are not common are gathered.
    base = np.concatenate([[0], np.cumsum(np.diff(w.first) // step + 1)])
    at, term = index.lookup_rare(w.hash)
    rows = w.row[at]
    inside = at - w.first[rows]
    last = inside // step
    keys, terms = [], []
    for back in range(-(-width // step)):
        p = last - back
        ok = (p >= 0) & (inside - p * step < width)
        keys.append(base[rows[ok]] + p[ok])
        terms.append(term[ok])
    pair = np.unique(np.concatenate(keys) * len(index.terms) + np.concatenate(terms))
    hot, block = index.blocks_reached(pair // len(index.terms), pair % len(index.terms), int(base[-1]))
    best: dict[tuple[int, int], float] = {}
    places: dict[tuple[int, int], list[np.ndarray]] = {}
    for p in np.unique(hot):
        row = int(np.searchsorted(base, p, side="right")) - 1
        lo = int(w.first[row] + (p - base[row]) * step)
        passage = index.lookup(w.hash[lo:min(lo + width, int(w.first[row + 1]))])
        for item, score in index.search(passage, block[hot == p]):
            best[row, item] = max(best.get((row, item), 0.0), score / index.own[item])
            places.setdefault((row, item), []).append(w.hash[max(int(w.first[row]), lo - width):min(lo + 2 * width, int(w.first[row + 1]))])
    if not best:
        return []
    out, held = [], {}
    for (row, item), score in sorted(best.items()):
        if row not in held:
            held = {row: next(Words(w.data, w.offsets[row:row + 2]).shingle_sets(SHINGLE))}
        text, around = held[row], places[row, item]
        out.append((row, item, score, *(_share(part[item], text, around) for part in (index.question, index.answer, index.whole))))
    return out


def _index_groups(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[Index]:
    """Indexes over all items, each of at most ``limit`` words (a longer single item has its own)."""
    rows = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = rows.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).head()["n"] or 0
    groups = max(1, -(-words // limit))
    for g in range(groups):
        part = rows if groups == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(groups)) == g)
        yield Index([(r["id"], r["text"]) for r in part.collect()])


PAIRS = "item_id long, score double, question_share double, answer_share double, item_share double"


def retrieve(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", limit: int = MAX_INDEX_WORDS) -> DataFrame:
    """Every retrieved (text, item) pair: doc_id, item_id, score, question_share, answer_share,
    item_share. No shuffle; one scan of the texts per index group."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    out = None
    for index in _index_groups(items, item_col, item_text_col, limit):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                data, offsets = text_buffers(batch.column(1))
                found = [(lo + f[0], *f[1:]) for lo, hi in chunks(offsets) for f in scan(index, data, offsets[lo:hi + 1])]
                if found:
                    columns = list(zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array([index.ids[i] for i in columns[1]], pa.int64()),
                         *(pa.array(c, pa.float64()) for c in columns[2:])],
                        names=["doc_id", "item_id", "score", "question_share", "answer_share", "item_share"])
        part = docs.select(docs[id_col], docs[text_col]).mapInArrow(run, f"doc_id {kind}, {PAIRS}")
        out = part if out is None else out.unionByName(part)
    return out


def contaminated(pairs: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """The pairs that the overlap check confirms: question and answer are held, or the item is."""
    return pairs.where(((F.col("question_share") >= contained) & (F.col("answer_share") >= contained)) | (F.col("item_share") >= contained))


def keep_uncontaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` (all columns) that no confirmed item is in. Rows go by themselves, not by
    id, so rows with null or repeated ids are judged each."""
    spark, out = docs.sparkSession, docs
    limit = kw.get("limit", MAX_INDEX_WORDS)
    for index in _index_groups(items, kw.get("item_col", "item_id"), kw.get("item_text_col", "text"), limit):
        shared = spark.sparkContext.broadcast(index)
        position = out.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, position=position) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                data, offsets = text_buffers(batch.column(position))
                keep = np.ones(batch.num_rows, dtype=bool)
                for lo, hi in chunks(offsets):
                    for row, _, _, q, a, whole in scan(index, data, offsets[lo:hi + 1]):
                        if (q >= CONTAINED and a >= CONTAINED) or whole >= CONTAINED:
                            keep[lo + row] = False
                yield batch if keep.all() else batch.filter(pa.array(keep))
        out = out.mapInArrow(run, out.schema)
    return out
