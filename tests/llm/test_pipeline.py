"""The stages, one by one and together."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_corpus_operators import plain_classes
from vitalgrid.llm import decontaminate, quality
from vitalgrid.llm.common import table


def test_stages_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = corpus_pipeline.keep_quality(spark, docs, sf_dir)
    assert kept.schema == docs.schema
    judged = quality.assess(docs, table(spark, sf_dir, "labels")).toPandas()
    assert sorted(kept.toPandas().doc_id) == sorted(judged[judged.kept].doc_id)

    all_docs = docs.toPandas()
    unique = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert unique.columns == docs.columns
    assert sorted(unique.toPandas().doc_id) == sorted(set(plain_classes(zip(all_docs.doc_id, all_docs.text)).values()))

    clean = corpus_pipeline.drop_benchmark(spark, docs, sf_dir)
    held = {r.doc_id for r in decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).collect()}
    assert held and clean.columns == docs.columns
    assert sorted(clean.toPandas().doc_id) == sorted(set(all_docs.doc_id) - held)

    safe = corpus_pipeline.redact_secrets(spark, docs, sf_dir)
    assert safe.columns == docs.columns and safe.count() == docs.count()
    assert safe.filter("n_chars <> char_length(text)").count() == 0
    told = spark.createDataFrame([(1, "token = 0123456789abcdef", "en", "s", 24)], docs.schema)
    assert corpus_pipeline.redact_secrets(spark, told, sf_dir).first().text == "token = [SECRET]"

    ids = corpus_pipeline.encode_text(spark, docs, sf_dir)
    assert ids.filter("not round_trip").count() == 0 and ids.count() == docs.count()


def test_run(spark, sf_dir):
    done = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert 0 < len(done) < len(pd.read_parquet(f"{sf_dir}/documents.parquet"))
    assert done.doc_id.is_unique and done.round_trip.all()


def test_stages_on_nothing(spark, sf_dir):
    nothing = table(spark, sf_dir, "documents").filter("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0


NAMES = ["_id", "_trusted", "_gone", "_held", "kept", "n_words", "score", "spans"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, sf_dir, name, stage):
    from test_corpus_operators import odd_docs

    docs = odd_docs(spark).withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in NAMES})
    done = stage(spark, docs, sf_dir)
    assert done.count() <= docs.count()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert done.columns == docs.columns
        assert all(r[c] == c + ("" if r.doc_id is None else str(r.doc_id)) for r in done.collect() for c in NAMES)


def test_rows_without_an_id_stay(spark, sf_dir):
    text = "the cat sat on the mat and looked at the very old dog again today"
    rows = [(None, text, "en", "a", 1), (None, text, "en", "b", 1), (1, text, "en", "c", 1), (1, text, "de", "d", 1), (2, text, "en", "e", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()
    assert sorted(r.source for r in left if r.doc_id is None) == ["a", "b"]
    assert [r.doc_id for r in left if r.doc_id is not None] == [1]
