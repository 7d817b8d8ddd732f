"""The pipeline on a small corpus with planted cases, and the registration of the queries."""

import re

import numpy as np

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.test_searches_and_joins import edited, prose


def planted(draw):
    """(rows, labels, items) and the ids that must go."""
    rows, labels, gone = [], [], set()
    for doc in range(400):
        text = prose(20_000 + doc, int(draw.integers(30, 90)))
        if doc % 5 == 0:
            for _ in range(3):
                text.insert(int(draw.integers(0, len(text))), str(draw.choice(["vilgrub", "vilgrock", "snark"])))
            gone.add(doc)
        rows.append((doc, " ".join(text)))
        labels.append((doc, 1, int(doc % 5 == 0)))
    base = prose(1, 200)
    rows += [(500 + i, " ".join(edited(base, i, 4 * min(i, 1)))) for i in range(12)]
    gone |= set(range(501, 512))
    line = " ".join(prose(2, 30))
    rows += [(600 + i, line + "\n" + " ".join(prose(30_000 + i, 60))) for i in range(6)]
    item = prose(3, 30)
    rows += [(700 + i, " ".join(prose(40_000 + i, 50) + edited(item, i, i) + prose(50_000 + i, 50))) for i in range(3)]
    gone |= {700, 701, 702}
    rows += [(800, None), (801, ""), (802, rows[1][1]), rows[2], (None, " ".join(prose(4, 50)))]
    gone |= {802}
    return rows, labels, [(1, " ".join(item))], gone


def test_stages_keep_clean_documents_and_drop_planted_ones(spark, tmp_path):
    rows, labels, items, gone = planted(np.random.default_rng(11))
    docs = [(doc, text, "en", "src", len(text or "")) for doc, text in rows]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = kept.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{tmp_path}/{number}"
        stage(spark, kept, str(tmp_path)).write.parquet(out)
        kept = spark.read.parquet(out)
        if number + 1 < len(corpus_pipeline.STAGES):
            assert kept.columns == columns, name
        if name == "line_dedup":
            texts = {r["doc_id"]: r for r in kept.collect()}
            assert texts[600]["text"].count("\n") == 1
            assert all("\n" not in texts[600 + i]["text"] for i in range(1, 6))
            assert all(r["n_chars"] == len(r["text"] or "") for r in texts.values())
    ids = [r[0] for r in kept.select("doc_id").distinct().collect()]
    assert set(ids) == {doc for doc, _ in rows} - gone


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark, tmp_path):
    a, b, c, d, item = (" ".join(prose(60_000 + i, 60)) for i in range(5))
    rows = [(9, a), (10, a), (10, b), (11, c), (11, f"{d} {item}"), (11, c), (None, b), (None, d), (None, d)]
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    once = corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path))
    assert sorted(map(tuple, once.collect()), key=str) == sorted(
        [(9, a), (10, b), (11, c), (11, f"{d} {item}"), (None, d)], key=str)
    clean = corpus_pipeline.without_benchmark(spark, docs, str(tmp_path))
    assert sorted(map(tuple, clean.collect()), key=str) == sorted((r for r in rows if item not in r[1]), key=str)


def test_a_table_with_its_own_key_column_and_an_empty_one(spark, tmp_path):
    a, item = " ".join(prose(70_000, 60)), " ".join(prose(70_001, 60))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(1, a, "mine", "other"), (2, a, "yours", None)], "doc_id bigint, text string, _key string, _KEY_ string")
    for stage in (corpus_pipeline.one_of_each_group, corpus_pipeline.without_benchmark):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "_key", "_KEY_"]
    assert [tuple(r) for r in docs.collect()] == [(1, a, "mine", "other")]
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        assert docs.count() == 0


def test_every_operator_has_a_query():
    names = list(contract.queries())
    assert [sum(bool(re.match(rf"op{n}_", name)) for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and "op6_url_filter" in contract.oracle_sql()
