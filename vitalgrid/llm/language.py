"""Language by mixture inference: which languages a text mixes, and in which proportions.

Every language is a hashed character n-gram model learned from labelled texts. A text is a mixture:
each word comes from language l with probability pi_l, and its likelihood under l is the product of
its n-gram probabilities. Expectation-maximisation estimates pi for every text; the set of languages
is chosen by penalised likelihood (BIC) among the strongest language, the strongest two, and so on up
to all learned languages; the prediction is the language with the largest proportion, and that
proportion is the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.llm.common import Texts, extended, held_out, in_arrow, over_texts, release, slices

#: Hash bins of the n-gram tables, per language.
BINS = 1 << 16
#: Byte n-grams of this many bytes inside a word and its borders.
ORDERS = (2, 3)
STEPS = 8
UNKNOWN = "und"

_U = np.uint64


def _grams(texts: Texts, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the word and bin of each n-gram of the words at the given byte spans; ASCII upper case
    counts as lower case."""
    length = end - start + 2  # a border on either side
    first = np.cumsum(length) - length
    total = int(length.sum())
    owner = np.repeat(np.arange(len(length)), length)
    code = np.repeat(start - first - 1, length) + np.arange(total)
    border = np.zeros(total, bool)
    border[first] = border[first + length - 1] = True
    code = _FOLD[texts.data[np.where(border, 0, code)]]
    code[border] = 256
    word, bins = [], []
    for n in ORDERS:
        at = np.flatnonzero(owner[: total - n + 1] == owner[n - 1 :])
        value = np.full(len(at), n, _U)
        for j in range(n):
            value = value * _U(0x100000001B3) + code[at + j]
        word.append(owner[at])
        bins.append(((value * _U(0x9E3779B97F4A7C15)) >> _U(32)).astype(np.int64) % BINS)
    return np.concatenate(word), np.concatenate(bins)


_FOLD = np.arange(256, dtype=_U)
_FOLD[65:91] += _U(32)


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order of name and log probabilities (languages x BINS, add-one smoothed) from all
    rows with a text and a language. Each task sends one row per language and bin at most."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                with np.errstate(over="ignore"):
                    words = Texts.of(part.column("text")).words
                    spelling, at, kind = np.unique(words.hash, return_index=True, return_inverse=True)
                    if not len(spelling):
                        continue
                    word, bins = _grams(words.texts, words.start[at], words.end[at])
                langs = part.column("lang").to_pylist()
                of = np.array(langs, dtype=object)[words.doc]
                for name in sorted(set(langs)):
                    times = np.bincount(kind[of == name], minlength=len(spelling))
                    have = sums.setdefault(name, np.zeros(BINS, np.int64))
                    have += np.bincount(bins, times[word], minlength=BINS).astype(np.int64)
            release()
        for name, have in sums.items():
            some = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(have[some])], names=["lang", "bin", "n"]
            )

    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    counts = in_arrow(rows, count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("cells")).collect()  # BINS cells each
    names = sorted(r["lang"] for r in packed)
    table = np.zeros((len(names), BINS))
    for r in packed:
        cells = np.array(r["cells"], dtype=np.int64)
        table[names.index(r["lang"]), cells[:, 0]] = cells[:, 1]
    table += 1
    return names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32) if names else table


def infer(texts: Texts, table: np.ndarray) -> np.ndarray:
    """Proportions (texts x languages) of the chosen language sets; 0 for a text without letters."""
    words, n, k = texts.words, len(texts), len(table)
    share = np.zeros((n, k))
    if not len(words.doc):
        return share
    with np.errstate(over="ignore"):
        spelling, at, kind = np.unique(words.hash, return_index=True, return_inverse=True)
        word, bins = _grams(texts, words.start[at], words.end[at])
    like = np.stack([np.bincount(word, row[bins], minlength=len(spelling)) for row in table])
    odds = np.exp(np.maximum(like - like.max(axis=0), -60)).astype(np.float32)[:, kind]
    present = np.flatnonzero(words.per_text)  # texts with words; theirs stand one after the other
    size, first = words.per_text[present], words.first[present]

    def fit(rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """EM for some of the present texts over the languages allowed to each (languages x rows):
        proportions, log likelihoods (of words relative to their best language), and an upper bound of the log
        likelihood under any proportions (log is concave: it gains at most the length times the log of the
        largest factor of a further step)."""
        length = size[rows]
        start = np.cumsum(length) - length
        of = np.repeat(np.arange(len(rows)), length)
        own = odds if len(rows) == len(present) else odds[:, np.repeat(first[rows] - start, length) + np.arange(len(of))]
        pi = (allowed / allowed.sum(axis=0)).astype(np.float32)
        for step in range(STEPS + 1):
            joint = own * pi[:, of]
            whole = joint.sum(axis=0) + np.float32(1e-30)
            if step == STEPS or allowed.sum(axis=0).max() == 1:
                found = np.add.reduceat(np.log(whole.astype(np.float64)), start)
                factor = np.add.reduceat(own / whole, start, axis=1).max(axis=0) / length
                return pi, found, found + length * np.log(np.maximum(factor, 1.0))
            joint /= whole
            pi = np.add.reduceat(joint, start, axis=1) / length.astype(np.float32)

    every = np.arange(len(present))
    full, full_fit, bound = fit(every, np.ones((k, len(present))))
    rank = np.argsort(np.argsort(-full, axis=0, kind="stable"), axis=0, kind="stable")
    chosen, fitted, _ = fit(every, (rank < 1).astype(float))
    chosen, cost, open_ = chosen.copy(), -2 * fitted, every
    for m in range(2, k + 1):  # all sizes, but for texts whose bound cannot pay for that many languages
        open_ = open_[-2 * bound[open_] + (m - 1) * np.log(size[open_]) < cost[open_] - 1e-9]
        if not len(open_):
            break
        if m == k:
            pi, fitted = full[:, open_], full_fit[open_]
        else:
            pi, fitted, _ = fit(open_, (rank[:, open_] < m).astype(float))
        penalised = -2 * fitted + (m - 1) * np.log(size[open_])
        gain = penalised < cost[open_] - 1e-9
        chosen[:, open_[gain]] = pi[:, gain]
        cost[open_[gain]] = penalised[gain]
    share[present] = chosen.T
    share[~_lettered(texts)] = 0
    return share


def _lettered(texts: Texts) -> np.ndarray:
    """Texts with a letter: an ASCII letter, or (checked one by one) any other character that is."""
    ascii_letter = np.zeros(256, bool)
    ascii_letter[[*range(65, 91), *range(97, 123)]] = True
    out = texts.counts(ascii_letter) > 0
    for i in np.flatnonzero(~out):
        raw = texts.data[texts.bounds[i] : texts.bounds[i + 1]].tobytes()
        out[i] = any(c.isalpha() for c in raw.decode("utf-8", "replace"))
    return out


def identify(docs: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``lang_mix`` (language -> proportion).

    A text that is null or has no letter gets ``und``, score 0 and an empty mix; so does every text
    when nothing was learned. Equal proportions go to the first name. Repeated rows agree; an empty
    table gives an empty result. Own columns with those names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((names, table))  # languages x BINS numbers
    rows = docs.drop("lang_pred", "score", "lang_mix")
    columns = rows.columns

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        names, table = shared.value
        texts = Texts.of(part.column("text"))
        if names:
            share = infer(texts, table)
        else:
            share = np.zeros((len(texts), 1))
        at, score = share.argmax(axis=1), np.clip(share.max(axis=1), 0.0, 1.0)
        pred = [names[i] if s > 0 else UNKNOWN for i, s in zip(at, score)]
        mix = [[(names[j], float(row[j])) for j in np.flatnonzero(row > 0.001)] for row in share]
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(mix, pa.map_(pa.string(), pa.float64()))],
            names=[*columns, "lang_pred", "score", "lang_mix"],
        )

    added = {"lang_pred": "string", "score": "double", "lang_mix": "map<string,double>"}
    return over_texts(rows, "text", work, extended(rows, added))


def labelled(docs: DataFrame) -> DataFrame:
    """The part of ``documents`` that may be learned from: text and language of rows not held out."""
    return docs.filter(~held_out("doc_id", 4, 2)).select(F.col("text").cast(T.StringType()).alias("text"), "lang")
