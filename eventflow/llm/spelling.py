"""Spelling variants of a vocabulary, by an index of variable-length grams.

1. *Gram dictionary.* The grams of 2 to ``LONGEST`` code points of all words are counted in Spark; the
   frequent ones are kept (at most ``FREQUENT`` a length by the threshold, whatever the vocabulary). A word's
   gram at a position starts with two code points and grows while it is frequent, so rare grams stay short
   and frequent ones are cut into rarer, longer ones.
2. *Decomposition.* A word's grams are those of its positions that no earlier gram covers to the end.
3. *Affected grams.* For every place where one code point may be put in, taken out or replaced, the grams
   that this can destroy are counted: those over the place, and those after it that a new gram from before
   it could cover (only if the dictionary holds a gram that goes on like that). The largest count k is the
   word's bound: all but k of its grams are in every word one edit away, at the same distance from the
   start or, after the edit, from the end. Grams have at most half the length of the shorter word, so that
   at least one is always left; words are therefore indexed by the length of the shorter word of a pair.
4. *List merging.* Of a word with bound k only the k + 1 rarest grams enter lists, by (lengths, place,
   gram): two words one edit apart meet in at least one such list. The lists are the keys of a Spark join,
   which splits long ones; the join's own condition compares the words' letter masks (one edit changes two
   bits at most) and verifies the edit distance, so only true links leave it.

Corner cases: null and empty texts hold no words; a null id is written as an empty text where the id is
hashed; repeated rows are counted as often as they occur; texts of any length are cut into words by Spark's
own expression; other columns are not read; empty tables give an empty result. Words of equal counts: the
smaller by code points goes first. A word below ``min_length`` code points or ``min_count`` is no word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.shared import Tables

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form must occur this many times as often as its variant.
RATIO = 5
SHORTEST, LONGEST = 2, 6
#: Frequent grams of one length: at most so many, and only grams in more than LIST_LENGTH places.
FREQUENT, LIST_LENGTH = 20_000, 32
#: In a pair's key: words of equal length (place from the start), else place from the start or from the end.
EQUAL, FROM_START, FROM_END = 0, 1, 2


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, damage: int | None = None) -> DataFrame:
    """(word, n) of all texts. With ``damage``, a run loses code point ``h % length`` where ``damage`` divides
    h, the crc32 of ``<id>:<run>``: errors of a known rate."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= min_length).select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if damage:
        h = F.crc32(F.concat("id", F.lit(":"), "word"))
        cut = (h % F.length("word")).cast("int")
        runs = runs.select("word", h.alias("h"), cut.alias("cut")).select(
            F.when(F.col("h") % damage == 0, F.concat(F.substring("word", F.lit(1), F.col("cut")), F.expr("substring(word, cut + 2)"))).otherwise(F.col("word")).alias("word"))
        runs = runs.where(F.length("word") >= min_length)
    return runs.groupBy("word").agg(F.count("*").alias("n"))


def gram_frequencies(words: DataFrame) -> dict[str, int]:
    """The frequent grams and in how many places they are: a table bounded by FREQUENT."""
    size = words.agg(F.sum(F.length("word")).alias("places")).head()["places"] or 0
    floor = max(LIST_LENGTH, math.ceil(size / FREQUENT))
    grams = [F.transform(F.sequence(F.lit(1), F.length("word") - (q - 1)), lambda i, q=q: F.substring("word", i, F.lit(q))) for q in range(SHORTEST, LONGEST + 1)]
    one = words.where(F.length("word") >= LONGEST).select(F.explode(F.flatten(F.array(*grams))).alias("gram"))
    counted = one.groupBy("gram").count().where(F.col("count") > floor)
    return {r["gram"]: r["count"] for r in counted.collect()}


def decompose(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """The (start, end) of the word's grams."""
    out, reached, size = [], 0, len(word)
    for p in range(size - SHORTEST + 1):
        e = p + SHORTEST
        while e - p < longest and e < size and word[p:e] in frequent:
            e += 1
        if e > reached:
            out.append((p, e))
            reached = e
    return out


def affected(word: str, grams: list[tuple[int, int]], longest: int, frequent: dict[str, int], tails: set[str]) -> int:
    """The most grams that one edit can destroy. ``tails``: what frequent grams end with, whole grams apart."""
    size, worst = len(word), 0
    for i in range(size):  # code point i replaced or taken out
        worst = max(worst, sum(p <= i < e or p > i and e <= i + longest and word[i + 1:e - 1] in tails for p, e in grams))
    for i in range(size):  # one put in before code point i
        worst = max(worst, sum(p < i < e or p >= i and e < i + longest and word[i:e - 1] in tails for p, e in grams))
    return max(worst, sum(e == size and e - p < longest and word[p:e] in frequent for p, e in grams))  # one put in at the end


def letter_mask(word: str) -> int:
    """The word's letters as bits of a signed 64-bit integer."""
    mask = 0
    for c in word:
        mask |= 1 << (ord(c) & 63)
    return mask - (1 << 64) if mask >> 63 else mask


def _reach(shorter: int) -> int:
    return min(LONGEST, shorter // 2)


def list_keys(word: str, min_length: int, frequent: dict[str, int], tails: set[str]) -> Iterator[tuple[int, int, int, str, bool, bool]]:
    """The lists that a word enters: (kind, length of the shorter word, place, gram, as the shorter, as the longer)."""
    size, known = len(word), {}
    for shorter in (size, size - 1):
        if shorter < min_length:
            continue
        longest = _reach(shorter)
        if longest not in known:
            grams = decompose(word, longest, frequent)
            rare = sorted(grams, key=lambda g: (frequent.get(word[g[0]:g[1]], 0), word[g[0]:g[1]], g[0]))
            known[longest] = rare[:affected(word, grams, longest, frequent, tails) + 1]
        for p, e in known[longest]:
            if shorter == size:
                yield EQUAL, shorter, p, word[p:e], True, True
            yield FROM_START, shorter, p, word[p:e], shorter == size, shorter < size
            yield FROM_END, shorter, size - e, word[p:e], shorter == size, shorter < size


def _keys(min_length: int, frequent: dict[str, int]):
    tails = {g[k:] for g in frequent for k in range(1, len(g))}

    def run(batches):
        for b in batches:
            rows = [(w, n, mask, *k) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for mask in (letter_mask(w),)
                    for k in list_keys(w, min_length, frequent, tails)]
            if rows:
                cols = list(zip(*rows))
                types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["word", "n", "mask", "kind", "shorter", "place", "gram", "as_short", "as_long"])
    return run


def near_pairs(words: DataFrame, tables: Tables, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n, near, near_n) of all words one edit apart, in both directions. Words: (word, n), each word once."""
    if min_length < 2 * SHORTEST:
        raise ValueError(f"words need at least {2 * SHORTEST} code points")
    keys = tables.put(words.mapInArrow(_keys(min_length, gram_frequencies(words)),
                                       "word string, n long, mask long, kind int, shorter int, place int, gram string, as_short boolean, as_long boolean"), "lists")
    a, b = keys.where("as_short").drop("as_short", "as_long").alias("a"), keys.where("as_long").drop("as_short", "as_long").alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("gram", "kind", "shorter", "place")]
    letters = F.bit_count(F.col("a.mask").bitwiseXOR(F.col("b.mask"))) <= F.when(F.col("a.kind") == EQUAL, 2).otherwise(1)
    once = (F.col("a.kind") != EQUAL) | (F.col("a.word") < F.col("b.word"))
    met = a.join(b, same + [letters & once & (F.levenshtein("a.word", "b.word", 1) == 1)])
    one = met.select("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("near_n")).distinct()
    return one.unionByName(one.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def _roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """(word, root) for all words that have a form. Counts rise ``RATIO`` times a step, so chains are short;
    each round doubles the steps taken."""
    at = tables.put(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        moved = at.join(ahead, F.col("root") == F.col("at"), "left")
        if moved.where(F.col("ahead").isNotNull()).isEmpty():
            return at
        at = tables.put(moved.select("word", F.coalesce("ahead", "root").alias("root")), "roots")


def variants(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """Words (word, n; each word once) with their forms: word, form, root, n, n_near, form_n."""
    tables = Tables(words.sparkSession, "spelling")
    try:
        words = tables.put(words.where((F.length("word") >= min_length) & (F.col("n") >= min_count)).select("word", "n"), "words")
        best = near_pairs(words, tables, min_length).groupBy("word").agg(
            F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), F.col("near").alias("near"))).alias("best"))
        found = words.join(best, "word", "left")
        strong = -F.col("best.least") >= ratio * F.col("n")
        found = tables.put(found.select("word", F.when(strong, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                        F.when(strong, -F.col("best.least")).alias("form_n")), "found")
        roots = _roots(found.where(F.col("form").isNotNull()), tables)
        out = found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return tables.finish(out)
    except BaseException:
        tables.drop()
        raise
