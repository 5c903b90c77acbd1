"""Toxicity, decontamination and license scans on corner cases and against brute force."""

import random
import re
import zlib

import pytest
from helpers import documents, texts, with_clashes
from pyspark.sql import functions as F

from eventflow.llm import decontam, licenses, toxicity

SF = "/root/testdata/sf0.01"


def test_fold():
    assert toxicity.fold("IDI0T") == "idiot" and toxicity.fold("1d10t") == "idiot" and toxicity.fold("ｉdiоt") == "idiot"
    assert toxicity.fold("stupid$$$ 100 a1") == "stupid$$$ 100 a1" and toxicity.fold("$tup1d!") == "stupid!"


def test_hits_boundaries_and_exceptions():
    m = toxicity.Lexicon(terms={"trash": (2.0, 1.0)}, stems={"lowei": (1.0, 1.0)}, exceptions=("trash can",)).matcher()
    assert [h[:2] for h in m.hits("trash, TR4SH trashy a trash can loweinig flowei tr​ash")] == [(0, 5), (7, 12), (32, 37), (48, 53)]
    assert m.score("") == m.score(None) == m.score("clean words only") < 0.3 < m.score("trash trash trash")


def test_predict_rows_and_held_out_fold(spark):
    df = with_clashes(documents(spark))
    got = toxicity.predict(df, toxicity.Lexicon()).collect()
    assert len(got) == df.count()
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    kept = toxicity.keep_clean(df, toxicity.Lexicon())
    assert kept.columns == df.columns and kept.count() == df.count()
    assert toxicity.predict(documents(spark, []), toxicity.Lexicon()).count() == 0


def test_learning_without_toxic_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.learn_from(documents(spark), labels).terms == toxicity.DEFAULT_TERMS


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.predict(docs, toxicity.learn_from(docs, labels)).where("held_out").join(labels, "doc_id")
    right = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).head()[0]
    assert right > 0.98


def words(text):
    return re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))


def brute_leaks(docs, items):
    out = set()
    for i, t in items.items():
        w = words(t)
        want = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        for d, x in docs.items():
            v = words(x)
            have = {tuple(v[k:k + 5]) for k in range(max(1, len(v) - 4))}
            if want and len(want & have) >= 0.8 * len(want):
                out.add((d, i))
    return out


def test_decontamination_against_brute_force(spark):
    docs = texts(spark, SF)
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rng = random.Random(3)
    for k, t in enumerate(list(items.values())[:12]):  # planted: case, long neighbours, one changed word
        body = t.split(" ")
        if k % 3 == 2:
            body[len(body) // 2] = "changed"
        docs[10**6 + k] = " ".join(rng.choice(list(docs.values()))[:3000].split()) + " " + " ".join(body).upper() + " and more words " * (k * 40)
    docs = {d: t for d, t in list(docs.items())[-400:]}
    got = decontam.contaminated(decontam.retrieve(documents(spark, [(d, t, "en", "a", 1) for d, t in docs.items()]),
                                                  spark.createDataFrame(list(items.items()), "item_id long, text string"))).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    want = brute_leaks(docs, items)
    assert want <= found and all(r["item_share"] >= 0.75 for r in got)


def test_decontamination_corner_cases(spark):
    items = spark.createDataFrame([(1, "a row without an id but with some words in it"), (2, None), (3, ""), (4, "word"), (None, "same text twice over here for you and me"),
                                   (5, "same text twice over here for you and me")], "item_id long, text string")
    df = with_clashes(documents(spark))
    got = sorted((str(r["doc_id"]), str(r["item_id"])) for r in decontam.contaminated(decontam.retrieve(df, items)).collect())
    assert got == sorted([("None", "1"), ("5", "4"), ("7", "5"), ("7", "5"), ("7", "None"), ("7", "None")])
    kept = decontam.keep_uncontaminated(df, items)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 8]
    assert decontam.retrieve(documents(spark, []), items).count() == 0
    assert decontam.keep_uncontaminated(df, items.limit(0)).count() == df.count()


def test_index_groups_find_the_same(spark):
    items, docs = spark.read.parquet(f"{SF}/benchmark.parquet"), spark.read.parquet(f"{SF}/documents.parquet")
    def confirmed(**kw):
        return {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(decontam.retrieve(docs, items, **kw)).collect()}
    assert confirmed() == confirmed(limit=500) != set()


def test_licenses_against_exact_search(spark):
    docs = texts(spark, SF)
    notice = licenses.TEMPLATES[1][1]
    docs[10**6] = "before " * 50 + notice.upper().replace(" ", "\n") + " after" * 3000 + notice.replace("obtain", "get")
    df = with_clashes(documents(spark, [(d, t, "en", "a", 1) for d, t in docs.items()]))
    got = licenses.scan(df).collect()
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    for i, (name, t) in enumerate(licenses.TEMPLATES):
        want = {d for d, x in docs.items() if plain(t) in plain(x)}
        found = {r["doc_id"] for r in got if r["template"] == i and r["containment"] == 1.0}
        assert want == found, name
    planted = [r for r in got if r["doc_id"] == 10**6 and r["template"] == 1]
    assert sorted(r["containment"] == 1.0 for r in planted) == [False, True]
    for r in got:
        assert r["containment"] >= 0.8 and 0 <= r["start_byte"] < r["end_byte"] <= len(docs[r["doc_id"]].encode())


def test_license_corner_cases(spark):
    assert licenses.scan(with_clashes(documents(spark))).count() == 0
    assert licenses.scan(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.Templates([("x", "too short")])


def test_split_questions_and_answers(spark):
    """Question and answer verbatim with words between them, answers of fewer than five words among them."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    cuts = {i: decontam._answer_start(t) for i, t in items}
    short = [i for i, t in items if cuts[i] and len(t[cuts[i]:].split()) < 5]
    assert len(short) > 20
    around = "plain words that stand around it and say nothing at all "
    docs = [(i, around * 20 + t[:cuts[i]] + " Answer: " + t[cuts[i]:] + " " + around * 20, "en", "a", 1) for i, t in items]
    docs += [(10**6 + i, around * 20 + t[:cuts[i]] + around, "en", "a", 1) for i, t in items if i in short]  # the question alone
    found = decontam.contaminated(decontam.retrieve(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"))).collect()
    assert {i for i, _ in items} <= {r["doc_id"] for r in found if r["doc_id"] == r["item_id"]}
    assert not any(r["doc_id"] == 10**6 + r["item_id"] and r["item_share"] < 0.8 for r in found)


def test_license_siblings_get_their_own_names(spark):
    texts = {i: t for i, (_, t) in enumerate(licenses.TEMPLATES)}
    names = {i: n for i, (n, _) in enumerate(licenses.TEMPLATES)}
    texts[1000] = "This work is licensed under the GNU General Public License, version 1."
    texts[1001] = licenses.TEMPLATES[1][1].replace("obtain", "get")
    names[1001] = "Apache-2.0"
    texts[1002] = "\n".join(t for n, t in licenses.TEMPLATES if n in ("GPL-2.0", "GPL-3.0", "AGPL-3.0"))
    got = licenses.scan(documents(spark, [(i, "before it " + t + " after it", "en", "a", 1) for i, t in texts.items()])).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], set()).add(r["license"])
    assert found.pop(1002) == {"GPL-2.0", "GPL-3.0", "AGPL-3.0"}
    assert found == {i: {n} for i, n in names.items()}
