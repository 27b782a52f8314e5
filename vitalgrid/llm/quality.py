"""Quality by hashed n-gram likelihood ratio between a trusted target and the raw corpus.

Both sides are multinomials over ``bins`` hash bins of one- and two-word n-grams. A document's score
is the mean over its n-grams of log p_target(bin) - log p_raw(bin), so length does not matter, and
every document with a score of ``threshold`` or more is kept: no resampling, no random draws. A
document's own n-grams are taken out of both models before it is scored; otherwise rare words would
count against every text outside the trusted sample, and more so in a small corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import Texts, bin_counts, clean_columns, extended, free_name, in_arrow, mix, over_texts, release, slices

BINS = 16_384
#: Mean log ratio below which a document is unlike the trusted texts.
THRESHOLD = -0.09
#: Most trusted documents that are learned from (those with the smallest id hashes).
MAX_TRUSTED = 20_000

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEADING = (np.arange(256) & 0xC0) != 0x80
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids labelled good and never bad, at most ``max_trusted`` of them. Null ids and labels count
    for nothing; repeated rows count once."""
    good = (
        clean_columns(labels, {"doc_id": "long", "quality": "int"})
        .filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("worst"))
        .filter("worst >= 1")
        .select("doc_id")
    )
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted)


def _bins(texts: Texts, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Text index and bin of every one- and two-word n-gram."""
    words = texts.words
    at, pairs = words.grams(2)
    doc = np.concatenate([words.doc, words.doc[at]])
    value = np.concatenate([mix(words.hash + np.uint64(1)), pairs])
    return doc, (value % np.uint64(bins)).astype(np.int64)


def flagged(docs: DataFrame, labels: DataFrame, max_trusted: int, mark: str = "_trusted") -> DataFrame:
    """``docs`` with a column ``mark``: whether it is trusted; the ids that travel are at most ``max_trusted``."""
    id = free_name(docs, "_id")
    ids = F.broadcast(trusted_ids(labels, max_trusted).withColumnRenamed("doc_id", id))
    return docs.join(ids, F.col("doc_id").cast("long") == F.col(id), "left").select(
        *[docs[f"`{c}`"] for c in docs.columns], F.col(id).isNotNull().alias(mark)
    )


def learn(rows: DataFrame, bins: int = BINS, mark: str = "_trusted") -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts by bin: of all texts, and of those with ``mark``. Each task sends one row
    per bin at most."""

    def count(batches):
        raw, target = np.zeros(bins, np.int64), np.zeros(bins, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                with np.errstate(over="ignore"):
                    doc, value = _bins(Texts.of(part.column("text")), bins)
                flag = part.column(mark).to_numpy(zero_copy_only=False)
                raw += np.bincount(value, minlength=bins)
                target += np.bincount(value[flag[doc]], minlength=bins)
            release()
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bin", "raw", "target"]
        )

    partial = in_arrow(rows.select("text", mark), count, "bin long, raw long, target long")
    sums = bin_counts(partial, bins, "bin", ["raw", "target"])
    return sums["raw"], sums["target"]


def ratios(texts: Texts, trusted: np.ndarray, raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Score of each text: its mean log ratio, add-one smoothed, its own n-grams left out of the
    models. 0 for a text without n-grams, and everywhere when nothing is trusted."""
    n, bins = len(texts), len(raw)
    if not target.sum():
        return np.zeros(n)
    doc, value = _bins(texts, bins)
    cell, own = np.unique(doc * bins + value, return_counts=True)
    doc, value = cell // bins, cell % bins
    length = np.bincount(doc, own, minlength=n)
    of_target = np.where(trusted[doc], own, 0)
    gain = np.log(target[value] - of_target + 1) - np.log(raw[value] - own + 1)
    total = np.bincount(doc, own * gain, minlength=n) / np.maximum(length, 1)
    base = np.log(raw.sum() - length + bins) - np.log(target.sum() - np.where(trusted, length, 0) + bins)
    return np.where(length > 0, total + base, 0.0)


def facts(texts: Texts) -> dict[str, np.ndarray]:
    """Counts over whole texts: words, their characters, symbols, repeated lines, and words inside
    8-word windows that the text holds twice or more (the first occurrence included)."""
    words, n = texts.words, len(texts)
    lead = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(_LEADING[texts.data], out=lead[1:])
    chars = np.bincount(words.doc, lead[words.end] - lead[words.start], minlength=n).astype(np.int64)

    start, end, doc = texts.spans(_NEWLINE)  # a line with a word isn't empty
    held = np.searchsorted(words.start, start) < np.searchsorted(words.start, end)
    start, end, doc = start[held], end[held], doc[held]
    dup_lines = np.bincount(doc, minlength=n) - _distinct(doc, texts.hashes(start, end), n)

    at, value = words.grams(WINDOW)
    order = np.lexsort((value, words.doc[at]))
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = (value[order][1:] == value[order][:-1]) & (words.doc[at][order][1:] == words.doc[at][order][:-1])
    twice = at[order][same[1:] | same[:-1]]
    cover = np.zeros(len(words.doc) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    repeated = np.bincount(words.doc[np.cumsum(cover)[:-1] > 0], minlength=n)
    return {
        "n_words": words.per_text,
        "word_chars": chars,
        "n_symbols": texts.counts(_SYMBOL),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
    }


def _distinct(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return np.bincount(doc[new], minlength=n)


#: Columns that ``assess`` adds.
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"]


def assess(
    docs: DataFrame,
    labels: DataFrame,
    bins: int = BINS,
    threshold: float = THRESHOLD,
    max_trusted: int = MAX_TRUSTED,
) -> DataFrame:
    """One row per row of ``docs``, all its columns and the counts, the score and the verdict:
    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept``.
    Columns of ``docs`` with such names are replaced.

    Null text counts as empty; an empty text has score 0 and fails on its word count. Repeated rows
    are judged alike, a null id is kept as it is, an empty table gives an empty result.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept = [c for c in docs.columns if c not in ADDED]
    mark = free_name(docs, "_trusted")
    source = flagged(docs.select(*[F.col(f"`{c}`") for c in kept]), labels, max_trusted, mark)
    shared = docs.sparkSession.sparkContext.broadcast(learn(source, bins, mark))  # two tables of ``bins``

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts.of(part.column("text"))
        found = facts(texts)
        trusted = part.column(mark).to_numpy(zero_copy_only=False)
        score = ratios(texts, trusted, *shared.value)
        failed = (found["n_words"] < MIN_WORDS) | (
            100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"]
        )
        return pa.RecordBatch.from_arrays(
            [
                *[part.column(c) for c in kept],
                *[pa.array(found[k].astype(np.int64)) for k in names],
                pa.array(score),
                pa.array(failed),
                pa.array(~failed & (score >= threshold)),
            ],
            names=[*kept, *names, "score", "base_failed", "kept"],
        )

    added = {k: "long" for k in names} | {"score": "double", "base_failed": "boolean", "kept": "boolean"}
    return over_texts(source, "text", work, extended(source.drop(mark), added))
