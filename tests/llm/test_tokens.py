import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import documents, texts, with_clashes

from eventflow.llm import packing, tokencount, wordids

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a", "  a  b\n\n c\t<s> x ", "\n\n a", "▁a", "a▁▁b", "日本語 テスト🙂", "\x00a\r\n", "é" * 20, "a" * 40, "</s>[INST] ok", "don't İSTANBUL ΑΣ ſ é <|endoftext|> …,."]


def odd_texts(n):
    rng = random.Random(5)
    return ODD + ["".join(rng.choice("ab \n.▁é<s>1\tABÉ'İß…-") for _ in range(30)) for _ in range(n)]


@pytest.fixture(scope="module")
def counter():
    return tokencount.PrefixCounter(PIECES)


def test_counts_equal_the_library(counter, spark):
    every = odd_texts(1500) + list(texts(spark, "/root/testdata/sf0.001").values())
    assert [counter.count(t) for t in every] == [len(x) for x in counter.model.encode(every, num_threads=1)]


def test_every_prefix_equals_the_library(counter, spark):
    for text in odd_texts(60) + [t[:250] for t in list(texts(spark, "/root/testdata/sf0.001").values())[:15]]:
        table = counter.table(text)
        want = [len(counter.model.encode(text[:k])) for k in range(len(text) + 1)]
        assert table.counts().tolist() == want
        for budget in (0, 1, 3, 10):
            assert table.fits(budget) == max(k for k, n in enumerate(want) if n <= budget)


def test_count_tokens_rows(spark, counter):
    df = with_clashes(documents(spark))
    got = tokencount.count_tokens(df, PIECES, budgets=(5,)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in df.collect())
    for r, d in zip(got, df.collect(), strict=True):
        text = d["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(counter.model.encode(text)))
    assert tokencount.count_tokens(documents(spark, []), PIECES).count() == 0


def test_word_ids_equal_the_library():
    w = wordids.WordIds(WORDS)
    every = odd_texts(1500)
    want = [np.array(e.ids, "<u4").tobytes() for e in w.tokenizer.encode_batch(every, add_special_tokens=False)]
    assert [w.encode(t) for t in every] == want


def test_words_of_many_texts_are_learnt_together(monkeypatch):
    w = wordids.WordIds(WORDS)
    latin = ["".join(map(chr, range(k, k + 8))) for k in range(0, 400, 8)] + ["\u00b5M \u00c0\u00c9.\u00dfS\u00a0X\u0085Y", "STRASSE, STRASSE; Straße..."]
    signs = [f"{chr(c)}{t}x a{chr(c)}{t}" for c in range(0x530) if chr(c).isalnum() for t in (".", "..'")]
    texts = odd_texts(300) + latin + signs + [f"Word{'abcdefghij'[k % 10] * (k % 23)} tail. {k}" for k in range(300)]
    want = [np.array(e.ids, "<u4").tobytes() for e in w.tokenizer.encode_batch(texts, add_special_tokens=False)]
    calls, library = [], w._library
    monkeypatch.setattr(w, "_library", lambda x: calls.append(len(x)) or library(x))
    plain = [k for k, t in enumerate(texts) if not any(a in t for a in w.added)]
    assert w.encode_all([texts[k] for k in plain]) == [want[k] for k in plain] and len(calls) == 1
    assert w.encode_all(texts) == want and len(calls) == 1 + len(texts) - len(plain)
    # A memory that is full at once: words leave it, half by half, and are learnt again.
    for _ in range(2):
        assert [x for k in range(0, len(texts), 7) for x in w.encode_all(texts[k:k + 7], 40)] == want
    assert len(w.words) + len(w.older) < 500


def test_packing_encodes_texts_together(spark, monkeypatch):
    docs = [(k, "word " * (k % 7) + f"x{k}", "en", "a", 1) for k in range(50)]
    df, seen = documents(spark, docs).coalesce(1), []
    want = sorted(packing.pack(df, WORDS).collect())
    monkeypatch.setattr(packing, "ENCODED_CHARS", 40)
    assert sorted(packing.pack(df, WORDS).collect()) == want
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t, *_ in docs] + [{"doc_id": None, "text": None}])
    for group in packing._together(batch):
        assert len(group) == 1 or sum(len(t) for _, t in group) <= 40
        seen += group
    assert seen == [(i, t) for i, t, *_ in docs] + [(None, "")]


@pytest.mark.parametrize("k", [1, 2, 7])
def test_differencing_deals_all_sizes(k):
    rng = random.Random(k)
    sizes = [rng.randint(1, 500) for _ in range(60)]
    window, sums = packing.differencing(sizes, k)
    assert sorted(np.bincount(window, sizes, minlength=k).astype(int).tolist()) == sorted(sums.tolist())
    assert sums.max() - sums.min() <= 500 / 10


def check_pieces(rows, expected, capacity):
    """Every id of every document in one piece, sequences gapless and within the capacity."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, ids in expected.items():
        pieces = sorted(by_doc.pop(doc), key=lambda r: r["start"])
        at = 0
        for p in pieces:
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids) // 4
            assert p["ids_crc32"] == zlib.crc32(ids[4 * at:4 * (at + p["length"])])
            at += p["length"]
        assert at == len(ids) // 4
    assert not by_doc
    pad = used = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        used += at
        pad += 0 if at & (at - 1) == 0 else capacity - at
    return pad / max(used, 1)


@pytest.mark.parametrize("cut", [True, False])
def test_packing_rows(spark, cut):
    docs = texts(spark, "/root/testdata/sf0.001") | {10**6: "", 10**6 + 1: "long words here " * 9000}
    df = with_clashes(documents(spark, [(i, t or None, "en", "a", 1) for i, t in docs.items()])).repartition(3)
    w = wordids.WordIds(WORDS)
    expected = {i: w.encode(t) + (2).to_bytes(4, "little") for i, t in docs.items()}
    pad = check_pieces(packing.pack(df, WORDS, group_windows=16, cut=cut).collect(), expected, 4096)
    assert pad == 0 if cut else pad < 0.2


def test_packing_corner_cases(spark):
    rows = packing.pack(documents(spark), WORDS).collect()
    assert sum(r["doc_id"] is None for r in rows) >= 1 and {r["doc_id"] for r in rows if r["doc_id"]} == set(range(1, 9))
    assert packing.pack(documents(spark, []), WORDS).count() == 0


def test_windows_rise_when_capacity_is_exceeded():
    doc = (1, b"")
    pieces = [packing.Piece(doc, 0, 6) for _ in range(5)]
    assert len(packing.pack_group(pieces, 10, False)) == 5  # ceil(30 / 10) windows cannot hold them whole
