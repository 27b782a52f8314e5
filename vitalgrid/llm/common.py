"""Helpers of the corpus operators: words and hashes of whole batches of texts, exact and vectorised.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``. Those are ASCII, so byte runs and
character runs are the same words. Null text counts as empty everywhere.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes handled at once inside a task; one longer text is handled alone.
SLICE_BYTES = 250_000

#: Bytes of one Arrow batch between Spark and Python.
BATCH_BYTES = 4 << 20

#: Bits of a Bloom filter, and bits set for each value.
FILTER_BITS = 1 << 23
PROBES = 3

LARGE_BLOCK = 4 << 20
M_MMAP_THRESHOLD = -3  # glibc's name for the option

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 bits (the SplitMix64 constants)."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=_U) * _BASE)

_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n + n // 4, SLICE_BYTES), base, dtype=_U)
        steps[0] = 1
        _powers[name] = have = np.cumprod(steps, dtype=_U)
    return have[:n]


@dataclass
class Texts:
    """UTF-8 bytes of some texts, one after the other; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> "Texts":
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if not len(column):
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(raw[bounds[0] : bounds[-1]], bounds - bounds[0])

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @cached_property
    def _sums(self) -> "_Sums":
        return _Sums(self.data)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans; equal bytes give equal hashes wherever they stand."""
        if not len(start):
            return np.zeros(0, _U)
        down = _power(_BASE_INVERSE, len(self.data) + 1, "down")
        raw = (self._sums.prefix[end] - self._sums.prefix[start]) * down[start]
        return mix(raw + (end - start).astype(_U))

    def counts(self, member: np.ndarray) -> np.ndarray:
        """Per text, the number of its bytes for which the 256-entry table ``member`` is true."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(member[self.data], out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def spans(self, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes for which ``outside`` (256 entries) is false: start, end, text.
        A run never crosses from one text to the next."""
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = ~outside[self.data]
        starts = inside[1:] & ~inside[:-1]
        ends = ~inside[1:] & inside[:-1]
        cut = self.bounds[1:-1]
        joined = cut[inside[1:][cut] & inside[:-1][cut]]  # runs that meet at the end of a text
        starts[joined] = True
        ends[joined] = True
        start, end = np.flatnonzero(starts), np.flatnonzero(ends)
        return start, end, np.searchsorted(self.bounds, start, side="right") - 1

    @cached_property
    def words(self) -> "Words":
        # of a twin: words that lead back to the texts that keep them would be a cycle, and stay in memory
        # with all their arrays until the collector runs
        twin = Texts(self.data, self.bounds)
        twin._sums = self._sums
        return twin.runs(_SPACE)

    def runs(self, outside: np.ndarray) -> "Words":
        """Like ``words``, with other bytes (a 256-entry table) between them."""
        start, end, doc = self.spans(outside)
        return Words(self, start, end, doc, np.searchsorted(doc, np.arange(len(self) + 1)))


@dataclass
class _Sums:
    """Running sums over all bytes, made when the first hash is asked for."""

    data: np.ndarray

    @cached_property
    def prefix(self) -> np.ndarray:
        out = np.zeros(len(self.data) + 1, dtype=_U)
        np.cumsum(_BYTE[self.data] * _power(_BASE, len(self.data), "up"), dtype=_U, out=out[1:])
        return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Words:
    """Words of some texts: byte spans, text index of each, and where each text's words begin."""

    texts: Texts
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def hash(self) -> np.ndarray:
        return self.texts.hashes(self.start, self.end)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the first words of all n-word windows inside a text, and window hashes."""
        return windows(self.hash, self.doc, n)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Text index and hash of every n-word window; a text of 1 to n-1 words has one window of
        all its words, an empty text none."""
        at, value = self.grams(n)
        doc = self.doc[at]
        short = np.flatnonzero((self.per_text > 0) & (self.per_text < n))
        if len(short):
            extra = np.array([chain(self.hash[self.first[i] : self.first[i + 1]]) for i in short], _U)
            doc, value = np.concatenate([doc, short]), np.concatenate([value, extra])
            order = np.argsort(doc, kind="stable")
            doc, value = doc[order], value[order]
        return doc, value


def windows(value: np.ndarray, group: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of n neighbouring values that lie in one group: first positions and hashes."""
    count = len(value) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    at = np.flatnonzero(group[:count] == group[n - 1 :])
    total = np.zeros(count, _U)
    for j in range(n):
        total = total * _BASE + value[j : j + count]
    return at, mix(total[at] + _U(n))


def chain(values: np.ndarray) -> np.uint64:
    """Hash of one sequence of hashes; equals ``windows`` on a window of the same values."""
    total = np.zeros(1, _U)
    for v in values:
        total = total * _BASE + v
    return mix(total + _U(len(values)))[0]


def suffix_order(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array cut at ``depth`` tokens, by prefix doubling: positions in the order of their first
    ``depth`` tokens (the end sorts first); equal prefixes keep the order of position."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64)
    if tokens.dtype.kind == "i" and 0 <= int(tokens.min()) and int(tokens.max()) < 1 << 21:
        used = np.flatnonzero(np.bincount(tokens))
        ranks = np.zeros(int(used[-1]) + 1, np.int64)
        ranks[used] = np.arange(len(used))
        rank, kinds = ranks[tokens], len(used)
    else:
        used, rank = np.unique(tokens, return_inverse=True)
        rank, kinds = rank.astype(np.int64), len(used)

    # as many tokens as fit in one number beside the position make the first prefixes
    bits, place = int(kinds).bit_length(), int(n).bit_length()
    length = max(1, min(depth, (63 - place) // bits))
    first = rank + 1  # 0 beyond the end
    key = first.copy()
    for j in range(1, length):
        key <<= bits
        if j < n:
            key[:-j] |= first[j:]
    while length < depth:
        order, key = _sorted(key, place)
        rank = np.zeros(n, np.int64)
        rank[order[1:]] = np.cumsum(key[1:] != key[:-1])
        step = min(length, depth - length)
        key = rank * (n + 1)
        if step < n:
            key[:-step] += rank[step:] + 1
        length += step
    return _sorted(key, place)[0]


def _sorted(key: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their keys, equal keys by position, and the sorted keys. Keys that leave
    ``place`` bits for the position are sorted with it in one number."""
    if int(key.max()) >> (63 - place):
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = np.sort((key << place) | np.arange(len(key)))
    return both & ((1 << place) - 1), both >> place


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with about ``limit`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(size.astype(np.int64)) - size) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        yield batch.slice(a, b - a)


def over_texts(
    df: DataFrame,
    column: str,
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | T.StructType,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Apply ``work`` to slices of bounded text size, in the tasks that read them."""

    def run(batches):
        release()
        for batch in batches:
            for part in slices(batch, column, limit):
                with np.errstate(over="ignore"):
                    out = work(part)
                if out is not None and out.num_rows:
                    yield out
            release()

    return in_arrow(df, run, schema)


def in_arrow(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` over batches of ``BATCH_BYTES`` at most (or one row), however long the texts are."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back: a Python worker lives on after its task, beside the next stage's JVM.
    Blocks of ``LARGE_BLOCK`` bytes or more are mapped one by one from here on, so that freeing them is
    enough (glibc would raise that limit with every large block it sees)."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt") and hasattr(libc, "malloc_trim"):
        libc.mallopt(M_MMAP_THRESHOLD, LARGE_BLOCK)
        libc.malloc_trim(0)


def held_out(doc_id: str, parts: int, which: int):
    """Whether crc32 of the id as text leaves the remainder that is kept from learning; a null id
    doesn't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == which, F.lit(False))


def extended(df: DataFrame, added: dict[str, str]) -> T.StructType:
    """Schema of ``df`` with more columns at the end."""
    more = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in added.items()]
    return T.StructType([*df.schema.fields, *more])


def _probes(value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.stack([mix(value + _U(k)) % _U(FILTER_BITS) for k in range(PROBES)]).astype(np.int64)


def bloom(df: DataFrame, column: str) -> np.ndarray:
    """Bloom filter of a column of whole numbers. Its size is fixed: ``FILTER_BITS`` reach the driver at
    most, however many values there are; more values only make it less selective."""

    def bits(batches):
        own = np.zeros(FILTER_BITS // 64, _U)
        for batch in batches:
            at = _probes(batch.column(0).to_numpy().view(_U)).ravel()
            np.bitwise_or.at(own, at >> 6, _U(1) << (at & 63).astype(_U))
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(own[some].view(np.int64))], names=["at", "bits"])

    rows = in_arrow(df.select(column), bits, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows.collect():
        out[r["at"]] = r["bits"]
    return out.view(_U)


def maybe_in(table: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether values may be in a Bloom filter: never false for those that are."""
    hit = np.ones(len(value), bool)
    for probe in _probes(value):
        hit &= (table[probe >> 6] >> (probe & 63).astype(_U)) & _U(1) == 1
    return hit


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def clean_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """The named columns with their types, whatever else the table holds; absent ones are null."""
    return df.select(
        *[
            (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in wanted.items()
        ]
    )


def bin_counts(partial: DataFrame, bins: int, key: str, values: list[str]) -> dict[str, np.ndarray]:
    """Sum per-task partial counts by bin and bring the fixed-size table (``bins`` rows at most) to
    the driver."""
    rows = partial.groupBy(key).agg(*[F.sum(v).alias(v) for v in values]).collect()
    out = {v: np.zeros(bins, np.float64) for v in values}
    for r in rows:
        for v in values:
            out[v][r[key]] = r[v]
    return out
