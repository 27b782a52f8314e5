"""Exact groups against plain grouping, collisions and odd rows included."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from test_corpus_operators import LOWER, empty, odd_docs
from vitalgrid.llm import exact


def plain_groups(rows, keep=max):
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, members in ids.items():
        known = [i for i in members if i is not None]
        top = keep(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        for doc_id, n in Counter(members).items():
            out += [(doc_id, top, len(members), doc_id == top and k == 0, digest) for k in range(n)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ROWS = [
    (1, "Same Text"), (2, "same text"), (3, "same texT"), (3, "same text"), (4, "other"), (5, None), (6, ""), (6, None),
    (None, "other"), (None, "alone"), (None, "alone"), (7, "É"), (8, "é"), (9, "x" * 300_000), (10, "x" * 300_000), (11, "same text "),
]


@pytest.mark.parametrize("keep, plain", [("largest", max), ("smallest", min)])
def test_groups(spark, keep, plain):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert found(exact.marked(docs, keep)) == plain_groups(ROWS, plain)


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_collisions_are_told_apart(spark, bits):
    """A hash of a few bits puts different texts together; their bytes part them."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    weak = lambda content: F.substring(F.md5(content), 1, bits).cast("binary")
    assert found(exact.marked(docs, "largest", weak)) == plain_groups(ROWS)
    kept = {(r.doc_id, (r.text or "").translate(LOWER)) for r in exact.deduplicated(docs, "largest", weak).collect()}
    assert kept == {(top, t) for t, top in {(t or "").translate(LOWER): plain_groups_top(t) for _, t in ROWS}.items()}


def plain_groups_top(text):
    same = [i for i, t in ROWS if (t or "").translate(LOWER) == (text or "").translate(LOWER) and i is not None]
    return max(same) if same else None


def test_hot_group_and_many_copies(spark, monkeypatch):
    """A third of all rows are one text, most of them one row repeated; copies are made in lots."""
    monkeypatch.setattr(exact, "HOT", 10)
    monkeypatch.setattr(exact, "COPIES", 7)
    rows = [(1, "Hot")] * 40 + [(i, "hot") for i in range(2, 12)] + [(100 + i, f"text {i // 2}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(exact.marked(docs, "largest")) == plain_groups(rows)


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumns({"_hash": F.lit(1), "content": F.lit("x"), "keep_id": F.lit(3), "_row": F.lit(0)})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(exact.marked(docs)) == plain_groups(rows, min)
    kept = exact.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(t or "").translate(LOWER) for _, t in rows})
    assert exact.marked(empty(docs)).count() == 0 and exact.deduplicated(empty(docs)).count() == 0


def test_only_spark_expressions(spark, sf_dir):
    from vitalgrid.llm.queries import QUERIES

    plan = QUERIES["op12_exact_groups"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan
