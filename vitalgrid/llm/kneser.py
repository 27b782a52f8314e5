"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by the workers.

Tokens are 48-bit word hashes. Tasks count the bigrams of their texts and send them, sorted and
packed, to buckets by the hash of the first word; the bigrams of very frequent first words are spread
by the whole pair. A bucket merges its parts into one sorted hash array and writes it to the shared
folder; what it knows about words (distinct successors with count 1, 2, 3 or more; distinct
predecessors) goes to the bucket of that word, which writes one sorted array of its words. Workers map
those files and look up the sorted hashes of their own texts, so a task never holds the model, and the
number of buckets grows with the corpus.

p(z | y) = max(c(yz) - D(c(yz)), 0) / c(y) + g(y) p(z),  g(y) = (D1 n1(y) + D2 n2(y) + D3 n3(y)) / c(y)
p(z)     = max(a(z) - E(a(z)), 0) / A + g0 / (V + 1),    a(z): distinct words before z, A: their sum
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import SLICE_BYTES, Texts, clean_columns, extended, held_out, in_arrow, mix, over_texts, release, slices
from vitalgrid.session import scratch_path, stored

#: Tokens a bucket stands for, about.
BUCKET_TOKENS = 1_000_000
MIN_BUCKETS = 16
#: Bigrams a task collects before it sends them.
FLUSH = 1_000_000
#: Most first words whose bigrams are spread over all buckets: those with 1/HOT_WORDS of the tokens.
HOT_WORDS = 2_000

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_START, _END = mix(np.array([11, 12], _U)) >> _U(16)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, token and the token before of all texts: their words, A-Z in lower case, then one
    end. The first token of a text follows the start mark."""
    texts = Texts.of(column)
    words = Texts(_FOLD[texts.data], texts.bounds).words
    n = len(texts)
    doc = np.repeat(np.arange(n), words.per_text + 1)
    token = np.full(len(doc), _END, _U)
    token[np.arange(len(words.doc)) + words.doc] = words.hash >> _U(16)
    before = np.roll(token, 1)
    before[words.first[:-1] + np.arange(n)] = _START
    return doc, token, before


def _bucket(word: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(word) % _U(buckets)).astype(np.int64)


def _pair(y: np.ndarray, z: np.ndarray) -> np.ndarray:
    return mix(y * _GOLD + z)


def _pair_bucket(y: np.ndarray, z: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    out = _bucket(y, buckets)
    if len(hot):
        spread = np.isin(y, hot)
        out[spread] = (_pair(y[spread], z[spread]) % _U(buckets)).astype(np.int64)
    return out


# packed columns ------------------------------------------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Equal-length columns as compressed byte planes. The first, if sorted, goes as differences."""
    parts = [np.diff(columns[0].astype(_U), prepend=_U(0)), *columns[1:]]
    planes = [np.ascontiguousarray(p.astype(_U).view(np.uint8).reshape(-1, 8).T).tobytes() for p in parts]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    if not len(raw):
        return [np.zeros(0, _U)] * columns
    planes = raw.reshape(columns, 8, -1)
    out = [np.ascontiguousarray(p.T).view(_U).ravel() for p in planes]
    out[0] = np.cumsum(out[0], dtype=_U)
    return out


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows with equal keys added up, ordered by the keys."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]


def _by_bucket(bucket: np.ndarray, columns: list[np.ndarray], kind: str):
    """(kind, bucket, packed columns) of each bucket; rows keep their order."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-2))
    for a, b in zip(edges[:-1], edges[1:]):
        rows = order[a:b]
        yield kind, int(bucket[rows[0]]), pack(*[c[rows] for c in columns])


_SENT = "kind string, bucket int, data binary, n1 long, n2 long, n3 long, n4 long, total long"


def _sent(rows, tally=(0, 0, 0, 0, 0)) -> pa.RecordBatch:
    rows = list(rows)
    kinds, buckets, data = zip(*rows) if rows else ((), (), ())
    empty = [0] * len(rows)
    counts = [[int(t), *empty[1:]] if rows else [] for t in tally]  # the first row carries the tally
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(buckets, pa.int32()), pa.array(data, pa.binary()), *[pa.array(c, pa.int64()) for c in counts]],
        names=["kind", "bucket", "data", "n1", "n2", "n3", "n4", "total"],
    )


def _tally(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [int(counts.sum())]


# sorted hash arrays in files -----------------------------------------------------------------------


def _write(uri: str, key: np.ndarray, columns: list[np.ndarray]) -> None:
    """A sorted hash array: the width of a count in words of 32 bits (two if one of them needs it), a directory
    over the top 16 of 48 key bits, the other 32 bits, then the columns of whole counts. Written under a name of its own and renamed, so a task that runs again does no harm."""
    directory = np.searchsorted(key >> _U(32), np.arange((1 << 16) + 1, dtype=_U)).astype(np.uint32)
    width = 1 + any(len(c) and int(c.max()) >= 1 << 32 for c in columns)
    files, path = pyarrow.fs.FileSystem.from_uri(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with files.open_output_stream(draft) as out:
        out.write(np.uint32(width).tobytes())
        out.write(directory.tobytes())
        out.write((key & _U(0xFFFFFFFF)).astype(np.uint32).tobytes())
        for c in columns:
            out.write(c.astype(np.uint32 if width == 1 else _U).tobytes())
    files.move(draft, path)


class HashArray:
    """A mapped file of ``_write``. Files in a store that cannot be mapped are copied to an unnamed
    local file first, which vanishes with the worker."""

    def __init__(self, uri: str, columns: int):
        files, path = pyarrow.fs.FileSystem.from_uri(uri)
        if files.get_file_info(path).type == pyarrow.fs.FileType.NotFound:
            raw = np.zeros((1 << 16) + 2, np.uint32)
        elif isinstance(files, pyarrow.fs.LocalFileSystem):
            raw = np.memmap(path, np.uint32, "r")
        else:
            with tempfile.TemporaryFile() as copy, files.open_input_stream(path) as source:
                while chunk := source.read(1 << 22):
                    copy.write(chunk)
                copy.flush()
                raw = np.memmap(copy, np.uint32, "r")
        width, head = max(1, int(raw[0])), (1 << 16) + 2
        n = (len(raw) - head) // (1 + columns * width)
        self.directory, self.low = raw[1:head], raw[head : head + n]
        edge = [head + n + n * width * i for i in range(columns + 1)]
        self.columns = [raw[a:b].view(np.uint32 if width == 1 else _U) for a, b in zip(edge, edge[1:])]

    def __call__(self, key: np.ndarray) -> list[np.ndarray]:
        """Columns at the keys, 0 where a key is absent."""
        top, low = (key >> _U(32)).astype(np.int64), (key & _U(0xFFFFFFFF)).astype(np.uint32)
        first, last = self.directory[top].astype(np.int64), self.directory[top + 1].astype(np.int64)
        end = last.copy()
        while (open_ := first < last).any():
            middle = np.where(open_, (first + last) >> 1, 0)
            less = open_ & (self.low[middle] < low)
            first = np.where(less, middle + 1, first)
            last = np.where(open_ & ~less, middle, last)
        inside = first < end
        at = np.where(inside, first, 0)
        found = inside & (self.low[at] == low) if len(self.low) else inside
        return [np.where(found, c[at], 0) if len(c) else np.zeros(len(key)) for c in self.columns]


# counting ------------------------------------------------------------------------------------------


def _discounts(n1, n2, n3, n4) -> np.ndarray:
    """Discounts for counts 0, 1, 2, 3 and more (Chen and Goodman); halves where counts are missing."""
    if not (n1 and n2 and n3):
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


def train(texts: DataFrame) -> dict:
    """Count the model of a column ``text`` (null: empty) and write it to the shared folder. Returns a
    few numbers, at most ``HOT_WORDS`` word hashes, and the folder of the files."""
    spark = texts.sparkSession
    texts = texts.select("text")

    def count_words(batches):
        token, times, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text", 4 * SLICE_BYTES):
                with np.errstate(over="ignore"):
                    kinds, number = np.unique(_tokens(part.column("text"))[1], return_counts=True)
                token.append(kinds)
                times.append(number.astype(_U))
                held += len(kinds)
                if held >= FLUSH:
                    yield _words(token, times)
                    token, times, held = [], [], 0
            release()
        if token:
            yield _words(token, times)

    def _words(token, times):
        with np.errstate(over="ignore"):
            (word,), (number,) = _summed([np.concatenate(token)], [np.concatenate(times)])
            return _sent(_by_bucket(_bucket(word, parts), [word, number], "count"))

    def merge_words(batches):
        for bucket, blobs in _gathered(batches):
            columns = [unpack(b, 2) for _, b in blobs]
            (word,), (number,) = _summed([np.concatenate([c[0] for c in columns])], [np.concatenate([c[1] for c in columns])])
            big = np.argsort(number, kind="stable")[::-1][:HOT_WORDS]
            rows = [("count", bucket, pack(word, number)), ("big", bucket, pack(*[x[np.sort(big)] for x in (word, number)]))]
            yield _sent(rows, (len(word), 0, 0, 0, int(number.sum())))

    # words: their number is not known before, so the parts follow the size of the input
    extent = texts.agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("documents")).first()
    parts = int((extent["size"] or 0) / 6 // BUCKET_TOKENS) + MIN_BUCKETS
    words = stored(
        in_arrow(in_arrow(texts, count_words, _SENT).repartition(parts, "bucket"), merge_words, _SENT), "lm-words"
    )
    size = words.filter("kind = 'count'").agg(F.sum("n1").alias("v"), F.sum("total").alias("n")).first()
    distinct, total = size["v"] or 0, size["n"] or 0
    hot = _most_frequent(words.filter("kind = 'big'"), max(total // HOT_WORDS, BUCKET_TOKENS // 8))
    folder = _qualified(spark, scratch_path(spark, "lm"))

    def count_pairs(batches):
        first, second, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text", 4 * SLICE_BYTES):
                with np.errstate(over="ignore"):
                    _, token, before = _tokens(part.column("text"))
                first.append(before)
                second.append(token)
                held += len(token)
                if held >= FLUSH:
                    yield _pairs(first, second)
                    first, second, held = [], [], 0
            release()
        if first:
            yield _pairs(first, second)

    def _pairs(first, second):
        with np.errstate(over="ignore"):
            y, z = np.concatenate(first), np.concatenate(second)
            (y, z), (n,) = _summed([y, z], [np.ones(len(y), _U)])
            return _sent(_by_bucket(_pair_bucket(y, z, hot, parts), [y, z, n], "pair"))

    def merge_pairs(batches):
        for bucket, blobs in _gathered(batches):
            columns = [unpack(b, 3) for _, b in blobs]
            with np.errstate(over="ignore"):
                (y, z), (n,) = _summed(
                    [np.concatenate([c[i] for c in columns]) for i in (0, 1)], [np.concatenate([c[2] for c in columns])]
                )
                key = _pair(y, z) >> _U(16)
                order = np.argsort(key)
                _write(f"{folder}/pairs-{bucket}", key[order], [n[order]])
                word, group = np.unique(y, return_inverse=True)
                after = [np.bincount(group[pick], minlength=len(word)).astype(_U) for pick in (n == 1, n == 2, n >= 3)]
                last, before = np.unique(z, return_counts=True)
                rows = [
                    *_by_bucket(_bucket(word, parts), [word, *after], "after"),
                    *_by_bucket(_bucket(last, parts), [last, before.astype(_U)], "before"),
                ]
                yield _sent(rows, _tally(n))
            release()

    pairs = stored(
        in_arrow(in_arrow(texts, count_pairs, _SENT).repartition(parts, "bucket"), merge_pairs, _SENT), "lm-pairs"
    )

    def merge_facts(batches):
        for bucket, blobs in _gathered(batches):
            key, values = [], []
            for kind, blob in blobs:
                word, *rest = unpack(blob, {"count": 2, "after": 4, "before": 2}[kind])
                zero = np.zeros(len(word), _U)
                key.append(word)
                # count, predecessors, successors seen once, twice, more often
                values.append(
                    {"count": lambda r: [r[0], zero, zero, zero, zero], "before": lambda r: [zero, r[0], zero, zero, zero], "after": lambda r: [zero, zero, *r]}[kind](rest)
                )
            (word,), columns = _summed([np.concatenate(key)], [np.concatenate([v[i] for v in values]) for i in range(5)])
            _write(f"{folder}/words-{bucket}", word, columns)
            yield _sent([("word", bucket, b"")], _tally(columns[1]))

    facts = words.filter("kind = 'count'").union(pairs)
    written = stored(in_arrow(facts.repartition(parts, "bucket"), merge_facts, _SENT), "lm-facts")
    sums = [F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "total")]
    upper, lower = (t.agg(*sums).fillna(0).first() for t in (pairs, written))
    below = _discounts(*lower[:4])
    rest = distinct - lower["n1"] - lower["n2"]  # every word of the texts has a word before it
    return {
        "folder": folder,
        "buckets": parts,
        "hot": hot,
        "documents": extent["documents"],
        "tokens": total,
        "distinct": distinct,
        "discounts": _discounts(*upper[:4]),
        "lower_discounts": below,
        "types": lower["total"],
        "lower_left": float(below[1] * lower["n1"] + below[2] * lower["n2"] + below[3] * rest),
    }


def _gathered(batches):
    """Rows of a task by bucket. A bucket's parts are packed counts of about ``BUCKET_TOKENS`` tokens."""
    held: dict[int, list] = {}
    for batch in batches:
        for kind, bucket, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "bucket", "data"))):
            held.setdefault(bucket, []).append((kind, data))
    while held:
        yield held.popitem()


def _most_frequent(big: DataFrame, least: int) -> np.ndarray:
    """Hashes of the words with ``least`` occurrences or more: at most tokens / least of them."""

    def pick(batches):
        for batch in batches:
            for blob in batch.column("data").to_pylist():
                word, number = unpack(blob, 2)
                keep = word[number >= least]
                yield pa.RecordBatch.from_arrays([pa.array(keep.view(np.int64))], names=["word"])

    found = in_arrow(big, pick, "word long").collect()
    return np.array([r["word"] for r in found], dtype=np.int64).view(_U)


def _qualified(spark, path: str) -> str:
    """The path with its scheme, in the form that pyarrow reads."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toString()
    return "file://" + full[len("file:") :] if full.startswith("file:/") and not full.startswith("file://") else full


# scoring -------------------------------------------------------------------------------------------

_open_files: dict[str, HashArray] = {}


def _lookup(model: dict, name: str, columns: int, bucket: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    out = [np.zeros(len(key)) for _ in range(columns)]
    order = np.lexsort((key, bucket))
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-2))
    for a, b in zip(edges[:-1], edges[1:]):
        rows = order[a:b]
        uri = f"{model['folder']}/{name}-{bucket[rows[0]]}"
        if uri not in _open_files:
            if len(_open_files) >= 5_000:  # maps are cheap, but their number has limits
                _open_files.clear()
            _open_files[uri] = HashArray(uri, columns)
        for o, found in zip(out, _open_files[uri](key[rows])):
            o[rows] = found
    return out


def _grade(column: pa.Array, model: dict) -> tuple[np.ndarray, ...]:
    """Per text: tokens, known tokens, log10 by add-one unigrams, log10 by the model."""
    doc, token, before = _tokens(column)
    n, buckets = len(column), model["buckets"]
    kinds, at = np.unique(np.append(token, _START), return_inverse=True)
    count, prior, once, twice, more = _lookup(model, "words", 5, _bucket(kinds, buckets), kinds)
    # every previous token is itself a token of the batch, or the start mark
    prev = np.roll(at[:-1], 1)
    prev[before == _START] = at[-1]
    at = at[:-1]
    d, e = model["discounts"], model["lower_discounts"]
    context = count.copy()
    context[kinds == _START] = model["documents"]
    left = (d[1] * once + d[2] * twice + d[3] * more) / np.maximum(context, 1)
    share = 1.0 / (model["distinct"] + 1)
    if model["types"]:
        low = (np.maximum(prior - e[np.minimum(prior, 3).astype(int)], 0) + model["lower_left"] * share) / model["types"]
    else:
        low = np.full(len(kinds), share)
    key = _pair(before, token)
    pairs, first, back = np.unique(key, return_index=True, return_inverse=True)
    bucket = _pair_bucket(before[first], token[first], model["hot"], buckets)
    seen = _lookup(model, "pairs", 1, bucket, pairs >> _U(16))[0][back]
    p = low[at].copy()
    known = context[prev] > 0
    gain = np.maximum(seen - d[np.minimum(seen, 3).astype(int)], 0) / np.maximum(context[prev], 1)
    p[known] = (gain + left[prev] * p)[known]
    base = (count[at] + 1) / (model["tokens"] + 1 * (model["distinct"] + 1))
    return (
        np.bincount(doc, minlength=n),
        np.bincount(doc[count[at] > 0], minlength=n),
        np.bincount(doc, np.log10(base), minlength=n),
        np.bincount(doc, np.log10(p), minlength=n),
    )


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10
    probability of the whole text) and ``perplexity`` (per token). Own columns of those names go.

    A null or empty text is its end token alone. Without training texts every probability is 1 /
    (0 + 1), so the scores are 0. Repeated rows score alike; an empty table gives an empty result.
    """
    added = {"n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double", "perplexity": "double"}
    rows = docs.drop(*added)
    columns = rows.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # numbers and at most HOT_WORDS hashes

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        tokens, known, base, total = _grade(part.column("text"), shared.value)
        return pa.RecordBatch.from_arrays(
            [
                *part.columns,
                pa.array(tokens.astype(np.int64)),
                pa.array(known.astype(np.int64)),
                pa.array(np.full(len(tokens), shared.value["tokens"], np.int64)),
                pa.array(base),
                pa.array(total),
                pa.array(10.0 ** (-total / np.maximum(tokens, 1))),
            ],
            names=[*columns, *added],
        )

    return over_texts(rows, "text", work, extended(rows, added), 6 * SLICE_BYTES)


def training_texts(docs: DataFrame) -> DataFrame:
    """Texts of the documents that may be learned from."""
    return clean_columns(docs, {"doc_id": "long", "text": "string"}).filter(~held_out("doc_id", 7, 2)).select("text")
