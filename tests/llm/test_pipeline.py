"""The pipeline's stages on planted documents against brute force, stage by stage."""

import corpus_pipeline
import public_tokenizers
from helpers import documents, with_clashes
from test_dedup import brute_components
from test_text_operators import brute_leaks
from test_tokens import check_pieces

from eventflow.llm import pii, toxicity, wordids
from eventflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(spark):
    rows = [tuple(r[c] for c in COLUMNS) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).limit(250).collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").head()["text"]
    clean = [r for r in rows if r[1] and len(r[1]) > 1500][:6]
    rows += [(10**6 + k, r[1], "en", "copy", 1) for k, r in enumerate(clean)]  # exact copies
    rows += [(2 * 10**6 + k, r[1] + " one more word", "en", "near", 1) for k, r in enumerate(clean)]  # near copies
    rows += [(3 * 10**6, "some words before it " + item + " and after", "en", "leak", 1)]
    rows += [(4 * 10**6, "you stupid IDI0T you moron " + "plain words follow here " * 3, "en", "toxic", 1)]
    rows += [(5 * 10**6, "pay with 4111 1111 1111 1111 today", "en", "pii", 1), (6 * 10**6, None, None, None, None), (7 * 10**6, "", "en", "x", 0)]
    return documents(spark, rows)


def test_stages_against_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near copies", "benchmark decontamination", "personal data", "packing"]
    docs = planted(spark)
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = [f for _, f in corpus_pipeline.STAGES]

    clean = stages[0](spark, docs, SF)
    assert clean.columns == COLUMNS
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    lexicon = toxicity.learn_from(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert 4 * 10**6 not in got and {10**6, 6 * 10**6, 7 * 10**6} <= got.keys()
    assert lexicon.matcher().score(before[4 * 10**6]) >= 0.3

    one = stages[1](spark, clean, SF)
    assert one.columns == COLUMNS
    found = brute_components(list(got.items()), 5, 80, 100)
    kept = {r["doc_id"]: r["text"] for r in one.collect()}
    assert kept == {i: got[i] for i in found if found[i] == i}
    assert not any(10**6 <= i < 3 * 10**6 for i in kept)

    free = stages[2](spark, one, SF)
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    leaks = {d for d, _ in brute_leaks({i: t or "" for i, t in kept.items()}, items)}
    assert free.columns == COLUMNS and 3 * 10**6 in leaks
    assert {r["doc_id"] for r in free.collect()} == kept.keys() - leaks

    hidden = stages[3](spark, free, SF)
    assert hidden.columns == COLUMNS
    texts = {r["doc_id"]: r["text"] for r in hidden.collect()}
    assert texts.keys() == kept.keys() - leaks
    assert "4111 1111" not in texts[5 * 10**6] and len(texts[5 * 10**6]) == len(kept[5 * 10**6]) and texts[6 * 10**6] is None
    assert texts == {r["doc_id"]: r["text"] for r in pii.pseudonymise(free, key=corpus_pipeline.PII_KEY).collect()}

    encoder = wordids.load(public_tokenizers.path("word_bpe_49k.json"))
    expected = {i: encoder.encode(t or "") + (2).to_bytes(4, "little") for i, t in texts.items()}
    assert check_pieces(stages[4](spark, hidden, SF).collect(), expected, 4096) == 0


def test_run_over_the_whole_table(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    ids = {r["doc_id"] for r in rows}
    assert 0 < len(ids) <= spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_on_corner_cases(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, columns with names the operators use, an empty table."""
    rows = [r for r in documents(spark).collect()]
    rows = [tuple(r) for r in rows] + [(None, None, None, None, None), (1, "a second text under the first id, with words of its own kind", None, "d", 2)]
    docs = with_clashes(documents(spark, rows))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect())), name  # nothing to remove or replace
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r[0] for r in rows}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), SF).count() == 0
