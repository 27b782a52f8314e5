"""Benchmark leaks: n-gram seeds join passages to test items, Smith-Waterman scores the pairs.

One scan of the documents looks up every word n-gram in a Bloom filter of the items' n-grams (a table
of fixed size, whatever the size of the benchmark) and cuts out the passages around the hits. Every
n-gram of an item is a seed, since any one of them may be the only one that an edited copy has kept.
Passages that share a seed with an item, and enough words to reach the score at all, are aligned with
it word by word: a local alignment bears replaced, missing and added words. A pair is a leak if it
reaches ``LEAST`` of the score of a perfect copy.

Words here are runs of letters and digits (ASCII case ignored), so punctuation does not hide a copy.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import Texts, Words, bloom, clean_columns, free_name, maybe_in, mix, over_texts, windows
from vitalgrid.session import stored

GRAM = 3
LEAST = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Pairs aligned together.
TOGETHER = 32

_U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def _words(column: pa.Array) -> Words:
    texts = Texts.of(column)
    return Texts(_FOLD[texts.data], texts.bounds).runs(_OUTSIDE)


def item_grams(items: DataFrame) -> DataFrame:
    """(item_id, gram) of all items with an id; an item of fewer than ``GRAM`` words has none."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = _words(part.column("text"))
        at, gram = windows(words.hash, words.doc, GRAM)
        ids = part.column("item_id").take(pa.array(words.doc[at]))
        return pa.RecordBatch.from_arrays([ids, pa.array(gram.view(np.int64))], names=["item_id", "gram"])

    rows = clean_columns(items, {"item_id": "long", "text": "string"}).filter("item_id is not null")
    return over_texts(rows, "text", work, "item_id long, gram long").distinct()


def passages(docs: DataFrame, filtered: np.ndarray, reach: int) -> DataFrame:
    """(doc_id, at, text, grams): stretches of ``reach`` words on either side of filter hits, overlapping
    ones joined, with the hits inside. ``at`` is the first word's number in the document."""
    shared = docs.sparkSession.sparkContext.broadcast(filtered)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        table = shared.value
        words = _words(part.column("text"))
        at, gram = windows(words.hash, words.doc, GRAM)
        hit = maybe_in(table, gram)
        at, gram = at[hit], gram[hit]
        if not len(at):
            return None
        doc = words.doc[at]
        low = np.maximum(at - reach, words.first[doc])
        high = np.minimum(at + GRAM + reach, words.first[doc + 1])
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])]))
        last = np.append(new[1:], len(at)) - 1
        low, high, doc = low[new], high[last], doc[new]
        data = words.texts.data
        texts = [data[words.start[a] : words.end[b - 1]].tobytes().decode() for a, b in zip(low, high)]
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(new, len(at)).astype(np.int32)), pa.array(gram.view(np.int64))
        )
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(doc)), pa.array(low - words.first[doc]), pa.array(texts, pa.string()), lists],
            names=["doc_id", "at", "text", "grams"],
        )

    rows = clean_columns(docs, {"doc_id": "long", "text": "string"}).filter("doc_id is not null")
    return over_texts(rows, "text", work, "doc_id long, at long, text string, grams array<long>").distinct()


def reachable(passage: Words, item: Words, least: float) -> np.ndarray:
    """Pairs i that may reach ``least``: a score is at most ``MATCH`` for each word of item i that
    stands in passage i."""
    here = np.isin(mix(item.hash + mix(item.doc.astype(_U))), mix(passage.hash + mix(passage.doc.astype(_U))))
    common = np.bincount(item.doc[here], minlength=len(item.texts))
    return np.flatnonzero(common / np.maximum(item.per_text, 1) >= least)


def align(passage: Words, item: Words, pairs: np.ndarray | None = None) -> np.ndarray:
    """Smith-Waterman score of passage i and item i, for all i or those in ``pairs`` (else 0), some
    pairs at a time."""
    out = np.zeros(len(passage.texts))
    order = np.lexsort((passage.per_text, item.per_text))
    if pairs is not None:
        order = order[np.isin(order, pairs)]
    for a in range(0, len(order), TOGETHER):
        rows = order[a : a + TOGETHER]
        x, y = _padded(item, rows, _U(0)), _padded(passage, rows, _U(1))
        slope = (-GAP * np.arange(y.shape[1])).astype(np.int32)
        before = np.zeros((len(rows), y.shape[1] + 1), np.int32)
        best = np.zeros(len(rows), np.int32)
        for i in range(x.shape[1]):
            now = np.where(y == x[:, i : i + 1], MATCH, MISMATCH) + before[:, :-1]
            np.maximum(now, before[:, 1:] + GAP, out=now)
            np.maximum(now, 0, out=now)
            # gaps along the passage: the best earlier cell less the distance
            before[:, 1:] = np.maximum.accumulate(now + slope, axis=1) - slope
            np.maximum(best, before.max(axis=1), out=best)
        out[rows] = best
    return out


def _padded(words: Words, rows: np.ndarray, filler: np.uint64) -> np.ndarray:
    length = words.per_text[rows]
    out = np.full((len(rows), max(1, int(length.max()))), filler, _U)
    for i, r in enumerate(rows):
        out[i, : length[i]] = words.hash[words.first[r] : words.first[r + 1]]
    return out


def leaks(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """One row (doc_id, item_id, score) per document and item that it holds a copy of; ``score`` is the
    best alignment's share of a perfect copy, ``least`` to 1.

    Null texts hold nothing. Rows without an id are left out on either side; rows that share an id count
    as one document or item. Items of fewer than ``GRAM`` words are not searched. Empty tables give an
    empty result.
    """
    items = clean_columns(items, {"item_id": "long", "text": "string"}).filter("item_id is not null and text is not null")
    grams = stored(item_grams(items), "item-grams")
    # An alignment of that score spans at most so many times the item's words: every added word costs GAP.
    span = 1 + MATCH * (1 - least) / -GAP
    longest = items.agg(F.max(F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"))).alias("n")).first()["n"] or 0
    found = stored(passages(docs, bloom(grams, "gram"), math.ceil(longest * span)), "passages")
    pairs = (
        found.select("doc_id", "at", F.explode("grams").alias("gram"))
        .join(grams, "gram")
        .select("doc_id", "at", "item_id")
        .distinct()
    )
    both = (
        found.select("doc_id", "at", F.col("text").alias("passage"))
        .join(pairs, ["doc_id", "at"])
        .join(items.select("item_id", F.col("text").alias("item")), "item_id")
        .select("doc_id", "item_id", "passage", "item")
    )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        passage, item = _words(part.column("passage")), _words(part.column("item"))
        share = align(passage, item, reachable(passage, item, least)) / (MATCH * np.maximum(item.per_text, 1))
        keep = pa.array(share >= least)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").filter(keep), part.column("item_id").filter(keep), pa.array(share).filter(keep)],
            names=["doc_id", "item_id", "score"],
        )

    scored = over_texts(both, "passage", work, "doc_id long, item_id long, score double")
    return scored.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def decontaminated(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` without the documents that hold a copy of an item. Rows without an id stay."""
    name = free_name(docs, "_held")
    held = leaks(docs, items, least).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(held, F.col("doc_id").cast("long") == F.col(name), "left_anti")
