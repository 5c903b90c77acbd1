import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, with_clashes
from pyspark.sql import functions as F

from eventflow.llm import kneser
from eventflow.llm.queries import QUERIES
from eventflow.llm.shared import Tables

END, BEGIN = ("end",), ("begin",)


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*re.findall("[^\x20\x09-\x0D]+", low), END]


class Brute:
    """The model of the definition, with dictionaries of word tuples."""

    def __init__(self, texts, order):
        self.order, grams = order, [Counter() for _ in range(order + 1)]
        raw = Counter()
        for t in texts:
            ws = [BEGIN] * (order - 1) + words(t)
            raw.update(words(t))
            for i in range(order - 1, len(ws)):
                grams[order][tuple(ws[i - order + 1:i + 1])] += 1
        for k in range(order - 1, 0, -1):
            for g, c in grams[k + 1].items():
                grams[k][g[1:]] += c if g[0] == BEGIN and g[1] == BEGIN else 1
        self.raw, self.grams, self.n, self.v = raw, grams, sum(raw.values()), len(raw)
        self.d, self.history = [None], [None]
        for k in range(1, order + 1):
            kinds = Counter(grams[k].values())
            self.d.append((0.0, *kneser.discounts([kinds[j] for j in (1, 2, 3, 4)])))
            h = defaultdict(lambda: [0, 0.0])
            for g, c in grams[k].items():
                h[g[:-1]][0] += c
                h[g[:-1]][1] += self.d[k][min(c, 3)]
            self.history.append(h)

    def p(self, history, w):
        if not history:
            total, rest = self.history[1][()] if self.v else (0, 0)
            c = self.grams[1][(w,)]
            return (max(c - self.d[1][min(c, 3)], 0) + rest / (self.v + 1)) / total if total else 1 / (self.v + 1)
        lower = self.p(history[1:], w)
        k = len(history) + 1
        if history not in self.history[k]:
            return lower
        total, rest = self.history[k][history]
        c = self.grams[k][(*history, w)]
        return max(c - self.d[k][min(c, 3)], 0) / total + rest / total * lower

    def row(self, text):
        ws = words(text)
        full = [BEGIN] * (self.order - 1) + ws
        score = sum(math.log10(self.p(tuple(full[i:i + self.order - 1]), w)) for i, w in enumerate(ws))
        base = sum(math.log10((self.raw[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in ws)
        return len(ws), sum(self.raw[w] > 0 for w in ws), base, score


ROWS = [(1, "the cat sat on the mat"), (2, "The CAT ate\tthe  rat\x0b\x0c and the dog"), (3, None), (4, ""), (5, " \n "), (6, "É\u00a0é the\u2003cat \x00 x"),
        (7, "the dog sat on the cat"), (7, "the dog sat on the cat"), (None, "a row without id the cat"), (8, "new words only here"), (9, "the " * 500 + "cat")]
ROWS += [(20 + i, " ".join("abcdefgh"[(i * j * j + j) % 8] for j in range(i))) for i in range(40)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_against_brute_force(spark, order, monkeypatch):
    monkeypatch.setattr(kneser, "BLOCK_BYTES", 300)
    monkeypatch.setattr(kneser, "SAMPLE", 0.9)
    df = with_clashes(spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3))
    held = F.coalesce(F.col("doc_id"), F.lit(0)) % 4 == 0
    got = kneser.learn_and_score(df, held, order).collect()
    brute = Brute([t for i, t in ROWS if (i or 0) % 4], order)
    want = sorted((i or 0, *brute.row(t)) for i, t in ROWS)
    mine = sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got)
    assert [r[:3] for r in mine] == [r[:3] for r in want]
    assert np.allclose([r[3:] for r in mine], [r[3:] for r in want], rtol=1e-9)
    assert {r["train_tokens"] for r in got} == {brute.n}


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    tables = Tables(spark, "test-kneser")
    model = kneser.train(df.select("text"), tables, 2)
    vocabulary = sorted({w for _, t in ROWS for w in words(t) if w != END})
    assert model.words == len(vocabulary) + 1 and model.tokens == sum(len(words(t)) for _, t in ROWS)
    arrays = kneser.Arrays(model.root)
    for h in ("the", "cat", "h", "neverseen"):
        b = kneser.tokens(pa.array([f"{h} {w}" for w in (*vocabulary, "neverseen")] + [h]))
        p = kneser.probabilities(b, model, arrays)[0]
        assert p[1:-2:3].sum() + p[-1] == pytest.approx(1.0)
    tables.drop()


def test_empty_and_nothing_to_learn(spark):
    assert kneser.learn_and_score(documents(spark, []), F.lit(False)).count() == 0
    got = kneser.learn_and_score(documents(spark), F.lit(True)).collect()
    assert len(got) == 10 and all(r["score"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    with pytest.raises(RuntimeError):
        kneser.mounted("s3a://bucket/folder")


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    brute = Brute([t for i, t in rows if not held(i)], kneser.ORDER)
    got = {r["doc_id"]: r for r in QUERIES["op11_kneser_ney"](spark, sf).collect()}
    assert len(got) == len(rows) and all(got[i]["held_out"] == held(i) for i, _ in rows)
    for i, t in rows[::7]:
        n, known, base, s = brute.row(t)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, brute.n)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(s)
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
