"""Jaccard join and substring removal against brute force, and on corner cases."""

import hashlib
import random
import re

import pytest
from helpers import documents, texts, with_clashes

from eventflow.llm import jaccard, suffix
from eventflow.llm.components import components
from eventflow.llm.shared import Tables


def shingles(text, size):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall("[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) or frozenset([tuple(w)])


def brute_components(rows, size=4, num=85, den=100):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t, size))
    parent = {i: i for i in sets}
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            if any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[i] for y in sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def planted(rng, n=60):
    """Groups of near copies around the threshold, passages in common, copies."""
    vocabulary = [f"w{k}" for k in range(400)]
    rows, common = [], [rng.choice(vocabulary) for _ in range(30)]
    for _ in range(n // 10):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 90))]
        for _ in range(10):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = common + words
            rows.append(" ".join(words) if rng.random() < 0.5 else "\n ".join(words).upper())
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [4096, 2])
def test_jaccard_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard, "HOT_LIST", hot)  # 2: every list is dealt out in blocks
    rows = list(enumerate(planted(random.Random(hot), 90)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(documents(spark, [(i, t, "en", "a", 1) for i, t in rows])).collect()}
    want = brute_components(rows)
    assert got == {i: (len(shingles(t, 4)), want[i]) for i, t in rows}


def test_jaccard_corner_cases(spark):
    df = with_clashes(documents(spark))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()), key=str)
    plain = {r["doc_id"]: r["text"] for r in df.collect()}
    assert len(got) == df.count()
    for i, n, c in got:
        assert n == len(shingles(plain[i], 4)) and c == i
    assert jaccard.join(documents(spark, [])).count() == 0
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns and kept.count() == df.count()


def test_repeated_ids_are_one_document(spark):
    a, b = "one two three four five six seven", "red orange yellow green blue indigo violet"
    df = documents(spark, [(5, a, "", "", 1), (5, b, "", "", 1), (3, a, "", "", 1), (9, b, "", "", 1)])
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.join(df).collect()} == {(5, 3), (3, 3), (9, 3)}


def test_a_group_of_near_copies_costs_a_check_each(spark, monkeypatch):
    """Copies that link with the middle of their group and not with each other, the middle having the largest id: the
    pairs of the group are not looked at."""
    rng, put, sizes = random.Random(7), Tables.put, {}

    def counted(self, df, name="t", **kw):
        got = put(self, df, name, **kw)
        sizes[name] = got.count()
        return got

    monkeypatch.setattr(Tables, "put", counted)
    base = [f"w{k}" for k in range(100)]
    rows = [(1000, " ".join(base))]
    for i in range(60):
        words = list(base)
        for at in (rng.randrange(10, 45), rng.randrange(55, 90)):
            words[at] = f"x{i}at{at}"
        rows.append((i, " ".join(words)))
    got = jaccard.join(documents(spark, [(i, t, "en", "a", 1) for i, t in rows]), size=5, num=80, den=100)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == brute_components(rows, 5, 80, 100) == {i: 0 for i, _ in rows}
    assert sizes["near"] <= 2 * len(rows) and sizes["pairs"] <= 4 * len(rows)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long"), Tables(spark, "t")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 30)}


def brute_remove(rows, length=50):
    seen, out = set(), []
    for _, text in sorted(rows):
        raw, own = (text or "").encode(), set()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            s = raw[k:k + length]
            own.add(s)
            if s in seen:
                gone[k:k + length] = b"\1" * length
        seen |= own
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return dict(zip((i for i, _ in sorted(rows)), out, strict=True))


@pytest.mark.parametrize("size", [1 << 20, 2000])
def test_substrings_against_brute_force(spark, monkeypatch, size):
    for name, value in (("BATCH_BYTES", size), ("PIECE_BYTES", size // 3), ("BUCKET_BYTES", 3 * size), ("RANGE_BYTES", 2 * size), ("FAMILY_BATCH", 97)):
        monkeypatch.setattr(suffix, name, value)
    rng = random.Random(1)
    passages = ["".join(rng.choice("ab cdé\n") for _ in range(rng.randint(40, 160))) for _ in range(6)]
    rows = [(k, "".join(rng.choice(passages) if rng.random() < 0.4 else "".join(rng.choice("xyz uvw") for _ in range(rng.randint(1, 90))) for _ in range(rng.randint(0, 6))))
            for k in range(80)]
    rows += [(200, "a" * 500), (201, "a" * 300 + "b" + "a" * 300), (202, "a" * 49), (203, None), (204, "ab" * 100), (205, rows[3][1])]
    df = with_clashes(documents(spark, [(i, t, "en", "a", 1) for i, t in rows]).repartition(3))
    got = suffix.remove_repeats(df, keep_text=True).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == brute_remove(rows)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in got)


def test_substrings_of_the_table_and_corner_cases(spark):
    rows = list(texts(spark, "/root/testdata/sf0.001").items())
    got = suffix.remove_repeats(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == brute_remove(rows)
    df = documents(spark)
    got = suffix.remove_repeats(df).collect()
    assert len(got) == df.count() and all(r["n_removed"] == 0 for r in got if r["doc_id"] != 6)
    assert [r["n_removed"] for r in got if r["doc_id"] == 6] == [0]  # a document is no source for itself
    assert suffix.remove_repeats(documents(spark, [])).count() == 0


@pytest.mark.parametrize("block", [7, 64, 1 << 14])
def test_least_places_against_brute_force(monkeypatch, block):
    import numpy as np

    monkeypatch.setattr(suffix, "BLOCK", block)
    rng = np.random.default_rng(3)
    distinct = rng.permutation(500).astype(np.uint64) + np.uint64(2**63)
    ties = np.concatenate([distinct, np.full(60, distinct[-1]), distinct[:9], np.tile(distinct[:5], 30), rng.integers(0, 3, 90).astype(np.uint64)])
    followed, plain = [], suffix._followed_places
    monkeypatch.setattr(suffix, "_followed_places", lambda v, width: followed.append(len(v)) or plain(v, width))
    for values in (ties, ties[:12], distinct):
        followed.clear()
        for width in (1, 2, 5, 12):
            want = [i + int(np.argmin(values[i:i + width])) for i in range(len(values) - width + 1)]
            assert suffix._least_places(values, width).tolist() == want
    assert not followed  # distinct values take the short way


@pytest.mark.parametrize("block", [9, 1 << 14])
def test_anchors_against_brute_force(monkeypatch, block):
    import numpy as np

    monkeypatch.setattr(suffix, "BLOCK", block)
    monkeypatch.setattr(suffix, "PIECE_BYTES", 300)
    rng = random.Random(8)
    rows = ["".join(rng.choice("ab c") for _ in range(n)).encode() for n in (0, 3, 49, 50, 0, 51, 700, 0, 120, 49, 90)] + [b"a" * 400, b"x" * 20]
    data, offsets = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    a = suffix.Anchors(data, offsets, 50)
    hashes = suffix.window_hashes(data, 16)
    whole = data.tobytes()
    assert len({whole[i:i + 16] for i in range(len(hashes))}) == len(set(hashes.tolist()))
    got = [(int(r), int(p) - int(back)) for r, p, low, high in zip(a.row, a.at, a.low, a.high, strict=True) for back in range(low, high + 1)]
    strings = {(r, int(offsets[r]) + i) for r, t in enumerate(rows) for i in range(len(t) - 49)}
    assert set(got) == strings and len(got) == len(strings)  # every string within a row, once
    for r, p, low, high in zip(a.row, a.at, a.low, a.high, strict=True):
        assert all(p == s + int(np.argmin(hashes[s:s + 35])) for s in range(p - high, p - low + 1))


def test_family_levels_stay_logarithmic():
    import numpy as np

    family, seen = suffix.Family(), set()
    rng = np.random.default_rng(0)
    for _ in range(200):
        batch = rng.integers(0, 5000, 40).astype(np.uint64)
        assert family.add(batch).tolist() == [int(x) in seen for x in batch]
        seen |= {int(x) for x in batch}
    assert len(family.levels) <= 13 and sum(map(len, family.levels)) == len(seen)


def test_keep_one_goes_by_rows(spark):
    """Rows of one id with different texts are judged each; rows that repeat id and text stay together; equal
    texts leave the smallest id."""
    a, b, c = ("the first text has these eleven words in it for you", "another text that shares no run of words with any", "a third one of its own kind and nobody repeats it here")
    rows = [(3, a), (5, a), (5, b), (5, b), (9, b), (7, c), (7, c), (2, None), (2, None), (2, ""), (4, ""), (None, a), (None, a), (8, a + " more")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, row_key long")
    kept = jaccard.keep_one(df, size=5, num=80, den=100)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(3, a), (5, b), (5, b), (7, c), (7, c), (2, None), (2, None), (2, ""), (4, ""), (None, a), (None, a)], key=str)
    assert jaccard.keep_one(df.where("false")).collect() == []
