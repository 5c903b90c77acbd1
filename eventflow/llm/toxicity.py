"""Toxicity by a weighted lexicon (Aho-Corasick over folded text).

A text is folded (case, look-alike letters of other scripts, digits and signs standing in for
letters inside a word), scanned once by an Aho-Corasick automaton of whole words and word stems,
and hits inside exception phrases are set aside. Each entry has a weight for its first hit and one
for being hit again (a word beginning that also occurs in harmless words says little once). The
entries' weights, the number of hits, and the hits per word of text give the score through a
logistic curve.

The lexicon's entries, weights and curve are learnt from labelled rows. Corner cases: null and empty texts
have no hit and get the curve's value for no hit; a null ``doc_id`` is scored like any row and is
never held out; repeated rows are scored each; with no toxic training row the lexicon is the
built-in one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.textscan import Words, chunks, mix, text_buffers

# Labelled rows that a lexicon is learnt from, at most (those with the smallest id hashes).
MAX_TRAINING_ROWS = 20_000
# A learnt entry is in so many training texts at least, whatever their number; of the training texts
# that hold it (or hold it again) this share is toxic, and of all entries learnt at most the share
# FALSE_ENTRIES is expected to be there by chance (Benjamini-Hochberg).
MIN_TEXTS, MIN_PRECISION, MIN_PRECISION_AGAIN, FALSE_ENTRIES = 3, 0.9, 0.75, 0.01
THRESHOLD = 0.3
MIN_STEM, MAX_STEM = 4, 12

# A general English list. Where the labelled rows hold an entry, they set its weights.
DEFAULT_TERMS = dict.fromkeys((
    "idiot", "idiots", "moron", "morons", "imbecile", "imbeciles", "cretin", "cretins", "halfwit", "nitwit", "dimwit", "dimwits", "dunce", "numbskull",
    "scum", "scumbag", "scumbags", "lowlife", "lowlifes", "degenerate", "degenerates", "subhuman", "subhumans", "vermin", "bastard", "bastards", "bitch",
    "bitches", "cunt", "cunts", "twat", "twats", "prick", "pricks", "wanker", "wankers", "whore", "whores", "slut", "sluts", "retard", "retards",
    "retarded", "asshole", "assholes", "arsehole", "arseholes", "dumbass", "jackass", "dickhead", "dickheads", "shithead", "dipshit", "douchebag",
    "douchebags", "faggot", "faggots", "tranny", "kike", "kikes", "wetback", "wetbacks", "raghead", "ragheads", "nigger", "niggers"), (4.0, 1.0)) | dict.fromkeys((
    "stupid", "loser", "losers", "worthless", "pathetic", "disgusting", "despicable", "contemptible", "repulsive", "shit", "shitty", "bullshit", "creep", "freak",
    "coward", "sissy"), (3.0, 1.0)) | dict.fromkeys(("trash", "clown", "dumb", "fool", "jerk", "crap", "garbage", "ugly", "liar"), (2.0, 1.0))
DEFAULT_STEMS = {"fuck": (4.0, 1.0), "motherfuck": (4.0, 1.0), "cocksuck": (4.0, 1.0)}
DEFAULT_EXCEPTIONS = ("trash can", "trash bin", "clown fish", "recycle trash", "sore loser")

# Letters of other scripts that look like a Latin letter.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d",
    "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ո": "n", "ս": "u",
    "α": "a", "ο": "o", "ρ": "p", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "​": "", "‌": "", "‍": "", "­": "", "⁠": "",
}
# Signs that stand for a letter inside a word.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}

_LOOKALIKE = re.compile("[" + "".join(LOOKALIKES) + "ａ-ｚ]")
_LOOKALIKE_TABLE = str.maketrans(LOOKALIKES | {chr(0xFF41 + i): chr(97 + i) for i in range(26)})
_SIGN_TABLE = str.maketrans(SIGNS)
_SIGNED = re.compile(r"[a-z][0-9@$!|]+[a-z]|(?<![0-9@$!|])[0-9@$!|]+[a-z]")
_TOKEN = re.compile(r"[a-z]*[0-9@$!|][a-z0-9@$!|]*")
_WORD = re.compile(r"[^\W\d_]+")


def _unsign(match: re.Match) -> str:
    token = match.group()
    core = token.rstrip("0123456789@$!|")
    if sum(c.isalpha() for c in core) < 2:
        return token
    return core.translate(_SIGN_TABLE) + token[len(core):]


def fold(text: str) -> str:
    """Lower case, look-alikes as Latin letters, signs inside a word as the letters they stand for."""
    text = text.lower()
    if not text.isascii() and _LOOKALIKE.search(text):
        text = text.translate(_LOOKALIKE_TABLE)
    if _SIGNED.search(text):
        text = _TOKEN.sub(_unsign, text)
    return text


@dataclass
class Lexicon:
    """``terms``: folded word -> (weight of the first hit, of further ones); ``stems``: the same for
    beginnings of words; ``exceptions``: phrases whose inside does not count; ``curve``: (bias, per
    weight, per log hits, per log hits in 100 words)."""

    terms: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(DEFAULT_TERMS))
    stems: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(DEFAULT_STEMS))
    exceptions: tuple[str, ...] = DEFAULT_EXCEPTIONS
    curve: tuple[float, float, float, float] = (-4.0, 1.0, 0.5, 0.5)

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.curve = lexicon.curve
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        self.weights = []
        for kind, words in (("word", lexicon.terms), ("stem", lexicon.stems)):
            for word, weights in words.items():
                entries.setdefault(word, []).append((kind, len(word), len(self.weights)))
                self.weights.append(weights)
        for phrase in lexicon.exceptions:
            entries.setdefault(fold(phrase), []).append(("except", len(fold(phrase)), -1))
        entries.pop("", None)
        for text, found in entries.items():
            self.automaton.add_word(text, tuple(found))
        self.empty = not entries
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, entry) of every counted hit in the folded text."""
        if self.empty or not text:
            return []
        folded = fold(text)
        n, found, masked = len(folded), [], []
        for last, entries in self.automaton.iter(folded):
            for kind, length, entry in entries:
                lo, hi = last + 1 - length, last + 1
                if lo and folded[lo - 1].isalpha():
                    continue
                if kind != "stem" and hi < n and folded[hi].isalpha():
                    continue
                (masked if kind == "except" else found).append((lo, hi, entry))
        if masked:
            found = [h for h in found if not any(lo <= h[0] and h[1] <= hi for lo, hi, _ in masked)]
        return found

    def features(self, text: str | None) -> tuple[float, float, float]:
        found = self.hits(text or "")
        if not found:
            return 0.0, 0.0, 0.0
        weight = 0.0
        for entry, n in Counter(h[2] for h in found).items():
            first, again = self.weights[entry]
            weight += first + (again if n > 1 else 0.0)
        words = text.count(" ") + text.count("\n") + 1
        return weight, math.log1p(len(found)), math.log1p(100.0 * len(found) / (words + 20))

    def score(self, text: str | None) -> float:
        z = self.curve[0] + sum(c * x for c, x in zip(self.curve[1:], self.features(text), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def candidates(text: str) -> Counter:
    """How often each word beginning and whole word (marked by a final ``$``) is in a folded text."""
    out: Counter = Counter()
    for w, n in Counter(_WORD.findall(fold(text))).items():
        if len(w) >= 3:
            out[w + "$"] += n
        for k in range(MIN_STEM, min(len(w), MAX_STEM) + 1):
            out[w[:k]] += n
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two min-hashes of every text's word pairs: copies of a text share them."""
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        one, two = [], []
        for lo, hi in chunks(offsets):
            for s in Words(data, offsets[lo:hi + 1]).shingle_sets(2):
                one.append(int(s.min().astype(np.int64)) if len(s) else 0)
                two.append(int(mix(s ^ np.uint64(0x1234567)).min().astype(np.int64)) if len(s) else 0)
        yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("toxic"), pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                                         names=["text", "toxic", "copy_a", "copy_b"])


_COUNTS = ("toxic", "clean", "toxic_again", "clean_again")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = {c: Counter() for c in _COUNTS}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            kind = "toxic" if label else "clean"
            found = candidates(text or "")
            counts[kind].update(found.keys())
            counts[kind + "_again"].update(t for t, n in found.items() if n > 1)
        terms = list(counts["toxic"].keys() | counts["clean"].keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([counts[c][t] for t in terms], pa.int64()) for c in _COUNTS)], names=["term", *_COUNTS])


def _surprise(hits, others, base: float, log=math.log, least=max, most=min):
    """Least log of one over the chance that of ``hits + others`` texts, each toxic at the rate
    ``base``, so many are toxic (the Chernoff bound of the binomial tail; 0 at the rate or below)."""
    n = hits + others
    share = least(hits / n, base)
    rest = least(1 - share, 1e-12)
    return n * (share * log(share / base) + rest * log(rest / most(1 - base + 1e-12, 1.0)))


def _significant(counts: DataFrame, base: float, keep: Iterable[str]) -> dict[str, tuple[int, ...]]:
    """The terms that the labels show to be toxic, and those of ``keep``, with their counts; a
    term is tested by the texts that hold it and by those that hold it again."""
    def exact(toxic, clean, precision):
        enough = (toxic >= MIN_TEXTS) & (toxic >= precision * (toxic + clean))
        surprise = _surprise(toxic, clean, base, F.log, lambda x, y: F.greatest(x, F.lit(y)), min)
        return F.when(enough, surprise).otherwise(0.0)

    tested = counts.agg(*[F.sum((F.col("toxic" + e) + F.col("clean" + e) >= MIN_TEXTS).cast("long")) for e in ("", "_again")]).head()
    tests = sum(n or 0 for n in tested)
    tries = counts.withColumn("first", exact(F.col("toxic"), F.col("clean"), MIN_PRECISION)).withColumn("more", exact(F.col("toxic_again"), F.col("clean_again"), MIN_PRECISION_AGAIN))
    # No bound of the procedure is over FALSE_ENTRIES: others need not return.
    hopeful = (F.greatest("first", "more") >= -math.log(FALSE_ENTRIES)) | F.col("term").isin(list(keep))
    got = tries.where(hopeful).collect()
    ranked = sorted((x for r in got for x in (r["first"], r["more"]) if x > 0), reverse=True)
    bound = math.inf
    for k, x in enumerate(ranked, 1):
        if x >= math.log(tests / (FALSE_ENTRIES * k)):
            bound = x
    return {r["term"]: (*(r[c] for c in _COUNTS), max(r["first"], r["more"]) >= bound) for r in got}


def _longest(kept: dict[str, tuple[int, ...]]) -> list[str]:
    """Of terms that begin alike, the longest one that is as frequent and exact as the shortest; a
    term is dropped when a chosen stem covers it, and a stem when it covers a chosen term."""
    worth = {t: max(c[0] * c[0] / (c[0] + c[1]), c[2] * c[2] / max(1, c[2] + c[3])) for t, c in kept.items()}
    longer_by: dict[str, list[str]] = {}
    for t in kept:
        longer_by.setdefault(t[:-1], []).append(t)
    chosen, stems, beginnings = [], set(), set()
    for term in sorted(kept, key=lambda t: (-worth[t], len(t), t)):
        if term in beginnings or any(term[:k] in stems for k in range(MIN_STEM, len(term) + 1)):
            continue
        best = term
        while not best.endswith("$"):
            longer = [t for t in longer_by.get(best, ()) if worth[t] >= 0.97 * worth[best]]
            if not longer:
                break
            best = min(longer)
        if best in beginnings:
            continue
        chosen.append(best)
        beginnings.update(best[:k] for k in range(1, len(best) + 1))
        if not best.endswith("$"):
            stems.add(best)
    return chosen


def _weights(counts: tuple[int, ...], n_toxic: int, n_clean: int) -> tuple[float, float]:
    """Log odds that a first hit, and being hit again, say for toxic texts."""
    toxic, clean, toxic_again, clean_again = counts
    first = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
    again = math.log((toxic_again + 0.5) / (toxic + 1)) - math.log((clean_again + 0.5) / (clean + 1))
    return round(min(6.0, max(0.0, first)), 4), round(min(6.0, max(0.0, again)), 4)


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          exceptions: Iterable[str] = DEFAULT_EXCEPTIONS, max_rows: int = MAX_TRAINING_ROWS) -> Lexicon:
    """A lexicon learnt from at most ``max_rows`` labelled rows (smallest id hashes first).

    Only ids and labels choose the sample; only texts make features. Copies of one text count once.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).dropna().groupBy("id").agg(F.max("toxic").alias("toxic"))
    # A hash bound leaves little more than max_rows rows before the exact limit.
    share = min(1.0, 1.2 * max_rows / max(1, known.count()) + 1e-9)
    place = F.pmod(F.xxhash64("id"), F.lit(2**40))
    sample = known.where(place <= int(share * 2**40)).orderBy(place, "id").limit(max_rows)
    # At most max_rows rows of two integers: small enough to send to every task.
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(sample), "id").select("text", "toxic"))
    sketched = rows.mapInArrow(_sketch, "text string, toxic int, copy_a long, copy_b long")
    for copy in ("copy_a", "copy_b"):  # one text, always the same, of those that share a min-hash
        sketched = sketched.groupBy(copy).agg(F.min(F.struct("text", "toxic", "copy_a", "copy_b")).alias("one")).select("one.*")
    rows = sketched.select("text", "toxic").persist()
    try:
        sizes = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
        n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
        if not n_toxic:
            return Lexicon(exceptions=tuple(exceptions))
        counts = rows.mapInArrow(_count, "term string, " + ", ".join(f"{c} long" for c in _COUNTS)).groupBy("term").agg(*[F.sum(c).alias(c) for c in _COUNTS])
        counts = counts.where(F.col("toxic") + F.col("clean") >= MIN_TEXTS).persist()
        general = [t + "$" for t in DEFAULT_TERMS] + [t for t in DEFAULT_STEMS]
        found = _significant(counts, n_toxic / (n_toxic + n_clean), general)
        counts.unpersist()
        lexicon = Lexicon(terms={}, stems={}, exceptions=tuple(exceptions))
        for t in _longest({t: c[:4] for t, c in found.items() if c[4]}):
            (lexicon.terms if t.endswith("$") else lexicon.stems)[t.rstrip("$")] = _weights(found[t][:4], n_toxic, n_clean)
        learnt = tuple(lexicon.stems)
        for t in general:
            into, usual = (lexicon.terms, DEFAULT_TERMS) if t.endswith("$") else (lexicon.stems, DEFAULT_STEMS)
            word = t.rstrip("$")
            if word not in into and not word.startswith(learnt):
                into[word] = _weights(found[t][:4], n_toxic, n_clean) if t in found else usual[word]
        lexicon.curve = _fit(rows, spark.sparkContext.broadcast(lexicon))
        return lexicon
    finally:
        rows.unpersist()


def _fit(rows: DataFrame, shared) -> tuple[float, ...]:
    """The logistic curve over the features, from the training rows' features (bounded)."""
    def features(batches):
        matcher = shared.value.matcher()
        for batch in batches:
            got = [matcher.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(pa.array([g[k] for g in got], pa.float64()) for k in range(3)), batch.column("toxic")], names=["a", "b", "c", "toxic"])

    got = rows.mapInArrow(features, "a double, b double, c double, toxic int").toArrow()
    x = np.column_stack([np.ones(len(got)), *(got[c].to_numpy() for c in "abc")])
    y = (got["toxic"].to_numpy() > 0).astype(float)
    w = np.zeros(4)
    ridge = np.diag([0.01, 0.1, 0.1, 0.1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(round(float(v), 6) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, *, text_col: str = "text", out: str = "toxic_score") -> DataFrame:
    """``docs`` with a score column (0 to 1) appended under ``out``; every row, whole texts, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    run = F.pandas_udf(_scorer(shared), "double")
    return docs.withColumn(out, run(F.col(text_col)))


def _scorer(shared):
    import pandas as pd

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = shared.value.matcher()
        for texts in batches:
            yield pd.Series([matcher.score(t if isinstance(t, str) else "") for t in texts], dtype="float64")

    scores.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return scores


def learn_from(docs: DataFrame, labels: DataFrame, **kw) -> Lexicon:
    """``learn`` on the training folds only: rows whose crc32(id as text) mod 4 is not 2."""
    id_col = kw.get("id_col", "doc_id")
    return learn(docs, labels.where(~held_out(F.col(id_col))), **kw)


def held_out(id_col):
    """The fold kept for evaluation: crc32(id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, lexicon: Lexicon, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    scored = score(base, lexicon, out="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, lexicon: Lexicon, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all its columns) that score below ``threshold``."""
    columns = docs.columns
    name = "toxic_score"
    while name in columns:
        name += "_"
    return score(docs, lexicon, out=name).where(F.col(name) < threshold).select(*columns)
