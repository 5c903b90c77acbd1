import random
import re
import zlib
from collections import Counter

import pytest
from helpers import documents, with_clashes

from eventflow.llm import spelling
from eventflow.llm.queries import QUERIES


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_words(rows, damage, min_length=6):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if damage and h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_length:
                out[w] += 1
    return out


def brute(counts, min_count=5, ratio=5):
    words = {w: n for w, n in counts.items() if n >= min_count}
    holes = {}  # words one edit apart share a word with one code point fewer (or are it)
    for w in words:
        for v in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            holes.setdefault(v, set()).add(w)
    near = {w: {o for v in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} for o in holes[v] if one_edit(w, o)} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def rows_of(df):
    rows = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("letters,sizes", [("ab", (6, 12)), ("abcdé", (6, 9)), ("abc", (12, 20))])
def test_all_links_of_dense_vocabularies(spark, letters, sizes, monkeypatch):
    monkeypatch.setattr(spelling, "LIST_LENGTH", 4)
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(500)}
    for w in list(words):  # variants of variants
        i = rng.randrange(len(w))
        words |= {w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w + rng.choice(letters)}
    counts = Counter({w: int(5 ** rng.uniform(0, 6)) for w in words if len(w) >= 6})
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    want = brute(counts)
    assert got == want and sum(r[4] for r in want) > len(words) and any(r[1] and r[2] != r[1] for r in want)


def test_bound_leaves_common_grams():
    rng = random.Random(8)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(6, 16))) for _ in range(300)]
    grams = Counter(w[i:i + q] for w in words for q in range(2, 7) for i in range(len(w) - q + 1))
    frequent = {g: n for g, n in grams.items() if n > 20}
    tails = {g[k:] for g in frequent for k in range(1, len(g))}
    for w in words:
        for longest in range(2, len(w) // 2 + 1):
            mine = spelling.decompose(w, longest, frequent)
            left = len(mine) - spelling.affected(w, mine, longest, frequent, tails)
            assert left >= 1 and mine[-1][1] == len(w)
            i = rng.randrange(len(w))
            for other in (w[:i] + rng.choice("abcd") + w[i + 1:], w[:i] + w[i + 1:], w[:i] + rng.choice("abcd") + w[i:], w + "a"):
                theirs = Counter(other[p:e] for p, e in spelling.decompose(other, longest, frequent))
                assert sum((Counter(w[p:e] for p, e in mine) & theirs).values()) >= left


def test_words_and_corner_cases(spark):
    rows = [(1, "Colour COLOUR colour, colour; colour! colours colours colours colours colours " * 7), (None, "colour Éclair éclair naïveté straße × ÷÷÷÷÷÷ don't_know x1word"),
            (3, None), (4, ""), (5, "1234 -- 日本語"), (5, "Repeat repeat"), (5, "Repeat repeat"), (6, "longest " * 3000), (7, "coloúr abcdefg" * 6)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    for damage in (None, 1, 2, 3):
        assert {r["word"]: r["n"] for r in spelling.words_of(df, damage=damage).collect()} == dict(brute_words(rows, damage))
    assert rows_of(spelling.variants(spelling.words_of(df))) == brute(brute_words(rows, None))
    assert spelling.variants(spelling.words_of(documents(spark, []))).count() == 0
    assert spelling.variants(spelling.words_of(documents(spark))).count() > 0


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(brute_words(rows, 199))
    assert rows_of(QUERIES["op12_spelling"](spark, sf)) == want and any(r[1] for r in want)
