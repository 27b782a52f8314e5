"""SentencePiece BPE with byte fallback, by suffix-array matching.

The distinct segments of a batch of texts (a run of spaces and what follows up to the next space; no
piece of a vocabulary reaches across) stand one after the other as one text. Its suffix array, cut at
the longest piece, is built by prefix doubling; every piece is binary-searched for the range of
suffixes that begin with it, many characters to a number, and the ranges give all edges (start, length,
piece). Edges are laid out by start position and relaxed: in every round each segment applies its best
open edge, that is, the best-ranked piece made of two neighbouring symbols, the leftmost of equals,
until none is left; only the edges beside a merge are looked up again. These are the merges of the
reference encoder, done for all segments at once.

Spaces are written as U+2581, which therefore decodes to a space, as in the reference encoder.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vitalgrid.llm.common import Texts, extended, in_arrow, over_texts, suffix_order

#: Text bytes encoded together.
TOGETHER = 1_500_000
#: Characters of a segment from which it is merged on its own, with a heap.
LONG = 256

_SPACE = 0x2581
_NORMAL, _BYTE = 1, 6


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, their scores, and kinds (1: normal, 6: byte, else: never produced)."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        """Read a SentencePiece model file of type BPE with byte fallback, identity normalisation and
        a dummy prefix."""
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, rule = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type != spec.BPE or not spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        if rule.name != "identity" or not rule.add_dummy_prefix or rule.remove_extra_whitespaces:
            raise ValueError("a model with identity normalisation and a dummy prefix is needed")
        found = cls(
            tuple(p.piece for p in proto.pieces), tuple(p.score for p in proto.pieces), tuple(p.type for p in proto.pieces)
        )
        for piece, kind in zip(found.pieces, found.kinds):
            bare = piece.lstrip(chr(_SPACE))
            if kind == _NORMAL and chr(_SPACE) in bare:
                raise ValueError(f"piece {piece!r} reaches across a space")
        return found

    @cached_property
    def width(self) -> int:
        return max(2, max((len(p) for p, k in zip(self.pieces, self.kinds) if k == _NORMAL), default=2))

    @cached_property
    def long_ids(self) -> np.ndarray:
        """Ids of the pieces of two characters or more."""
        return np.array([i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _NORMAL and len(p) > 1], np.int64)

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Code points of those pieces, padded with -1, and their lengths."""
        out = np.full((len(self.long_ids), self.width), -1, np.int32)
        for row, i in enumerate(self.long_ids):
            out[row, : len(self.pieces[i])] = [ord(c) for c in self.pieces[i]]
        return out, (out >= 0).sum(axis=1)

    @cached_property
    def rank(self) -> np.ndarray:
        """Order of merging by id: equal scores have equal ranks."""
        return np.unique(-np.array(self.scores), return_inverse=True)[1].astype(np.int32)

    @cached_property
    def single(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted code points of the one-character pieces, and their ids."""
        found = sorted((ord(p), i) for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _NORMAL and len(p) == 1)
        return np.array([c for c, _ in found], np.int64), np.array([i for _, i in found], np.int32)

    @cached_property
    def bytes_at(self) -> np.ndarray:
        """Id of each byte's piece."""
        out = np.zeros(256, np.int32)
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds)):
            if k == _BYTE:
                out[int(p[3:5], 16)] = i
        return out

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all pieces, one after the other, and where each begins; special pieces have none."""
        raw = [
            p.replace(chr(_SPACE), " ").encode() if k == _NORMAL else bytes([int(p[3:5], 16)]) if k == _BYTE else b""
            for p, k in zip(self.pieces, self.kinds)
        ]
        return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def _range(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (length[0] of them), begin[1], ..."""
    first = np.cumsum(length) - length
    return np.repeat(begin - first, length) + np.arange(int(length.sum()))


def _packed(codes: np.ndarray, bits: int, length: int) -> np.ndarray:
    """The first ``length`` of the last axis as one number, ``bits`` each."""
    out = np.zeros(codes.shape[:-1], np.int64)
    for j in range(length):
        out = (out << bits) | codes[..., j]
    return out


def edges(codes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of the pieces of two characters or more: start position and row in
    ``vocabulary.long_ids``."""
    table, length = vocabulary.table
    width = table.shape[1]
    if not len(table) or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # characters by number from 1, 0 for the end; pieces with other characters stand nowhere
    used = np.flatnonzero(np.bincount(codes))
    number = np.zeros(int(used[-1]) + 2, np.int64)
    number[used] = np.arange(1, len(used) + 1)
    pieces = number[np.minimum(table, len(number) - 1)]
    rows = np.flatnonzero((pieces > 0).sum(axis=1) == length)
    pieces, size = pieces[rows], length[rows]
    bits = int(len(used)).bit_length()
    step = 62 // bits
    text = np.zeros(len(codes) + width + step, np.int64)
    text[: len(codes)] = number[codes]
    order = suffix_order(text[: len(codes)], width)
    windows = np.lib.stride_tricks.sliding_window_view(text, step)
    packed = _packed(windows[: len(codes) + width], bits, step)

    low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(order), np.int64)
    for begin in range(0, width, step):  # the suffixes of low:high have the first ``begin`` characters
        some = np.flatnonzero((size > begin) & (low < high))
        part = np.zeros((len(some), step), np.int64)
        have = pieces[some, begin : begin + step]
        part[:, : have.shape[1]] = have
        least = _packed(part, bits, step)
        most = least | ((np.int64(1) << (bits * np.maximum(begin + step - size[some], 0))) - 1)
        if not begin:
            ahead, turn = packed[order], np.argsort(least)
            low[some[turn]] = np.searchsorted(ahead, least[turn])
            high[some[turn]] = np.searchsorted(ahead, most[turn], side="right")
        else:
            first, last = low[some], high[some]
            low[some] = _bisect(packed, order, begin, first, last, least)
            high[some] = _bisect(packed, order, begin, first, last, most + 1)
    found = np.maximum(high - low, 0)
    return order[_range(low, found)], np.repeat(rows, found)


def _bisect(
    packed: np.ndarray, order: np.ndarray, by: int, low: np.ndarray, high: np.ndarray, value: np.ndarray
) -> np.ndarray:
    """The first places of order[low:high] from which the numbers ``by`` further on are not below the values."""
    low, high = low.copy(), high.copy()
    rows = np.flatnonzero(low < high)
    while len(rows):
        middle = (low[rows] + high[rows]) >> 1
        less = packed[order[middle] + by] < value[rows]
        low[rows[less]] = middle[less] + 1
        high[rows[~less]] = middle[~less]
        rows = rows[low[rows] < high[rows]]
    return low


_NONE = np.iinfo(np.int32).max


def merge(codes: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of segments bounds[i]:bounds[i + 1] of ``codes`` after all merges: start positions, and
    ids (-1 for a single character)."""
    start, row = edges(codes, vocabulary)
    length = vocabulary.table[1][row]
    fits = start + length <= np.repeat(bounds[1:], np.diff(bounds))[start]
    start, row, length = start[fits], row[fits], length[fits]
    # by length and position: the edge's row + 1, or 0
    kind = np.uint16 if len(vocabulary.long_ids) < 1 << 16 else np.uint32
    at = np.zeros((int(length.max(initial=2)) - 1, len(codes)), kind)
    at[length - 2, start] = row + 1
    rank = np.concatenate([[_NONE], vocabulary.rank[vocabulary.long_ids]]).astype(np.int64)

    size = np.diff(bounds)
    done = []
    for i in np.flatnonzero(size > LONG):
        done.append(_merge_long(at, rank, int(bounds[i]), int(bounds[i + 1])))
    limit = 1
    while limit <= LONG:  # segments of like lengths, which end after like numbers of rounds
        some = np.flatnonzero((size >= limit) & (size < 2 * limit) & (size <= LONG))
        if len(some):
            done.append(_merge_short(at, rank, bounds[some], size[some]))
        limit *= 2
    symbol = np.sort(np.concatenate(done)) if done else np.zeros(0, np.int64)
    span = np.diff(np.append(symbol, len(codes)))
    found = np.full(len(symbol), -1, np.int64)
    merged = span > 1
    found[merged] = vocabulary.long_ids[at[span[merged] - 2, symbol[merged]].astype(np.int64) - 1]
    return symbol, found


def _merge_short(at: np.ndarray, rank: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The symbols that are left of short segments: in every round each segment merges its best open edge."""
    width = len(at) + 1
    stop = np.cumsum(size + 1)  # every segment has one more place, its end
    first, total = stop - size - 1, int(stop[-1])
    beyond = total + width  # what follows an end, too far for any edge
    after, before = np.arange(1, beyond + 2), np.arange(-1, total - 1)
    after[stop - 1] = after[beyond] = beyond
    place = _range(begin, size + 1)  # in ``at``; ends have no edges
    key = np.full(total, _NONE << 32, np.int64)  # rank of the edge that opens at a symbol, and the symbol
    alive = np.ones(total, bool)
    alive[stop - 1] = False

    flat, rows = at.ravel(), at.shape[1]

    def look(i: np.ndarray) -> None:
        span = after[after[i]] - i
        near = np.flatnonzero(span <= width)
        i, span = i[near], span[near]
        key[i] = (rank[flat[(span - 2) * rows + place[i]]] << 32) | i

    look(np.arange(total))
    while True:
        best = np.minimum.reduceat(key, first)
        left = best[best < _NONE << 32] & 0xFFFFFFFF
        if not len(left):
            break
        gone = after[left]  # the right-hand symbol joins the left one
        alive[gone] = False
        key[gone] = key[left] = _NONE << 32
        after[left] = after[gone]
        before[after[left]] = left
        beside = before[left]
        beside = beside[beside >= 0]
        key[beside] = _NONE << 32
        look(left)
        look(beside)
    return place[alive]


def _merge_long(at: np.ndarray, rank: np.ndarray, begin: int, end: int) -> np.ndarray:
    """The same merges in one long segment, with a heap of open edges."""
    n = end - begin
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []
    width = len(at) + 1

    def push(i: int) -> None:
        middle = after[i]
        if middle < n and after[middle] - i <= width:
            order = int(rank[at[after[middle] - i - 2, begin + i]])
            if order < _NONE:
                heapq.heappush(heap, (order, i, after[middle]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] != stop:
            continue
        gone = after[i]
        alive[gone] = False
        after[i] = stop
        if stop < n:
            before[stop] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return begin + np.flatnonzero(np.array(alive))


def encode_texts(column: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and where each text's ids begin. Null and empty texts
    have none."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    plain = pc.replace_substring(column, chr(_SPACE), " ")
    space, empty = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    full = pc.if_else(pc.equal(pc.binary_length(plain), 0), empty, pc.binary_join_element_wise(space, plain, empty))
    texts = Texts.of(full)
    if not len(texts.data):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    blank = texts.data == 0x20
    opens = np.zeros(len(blank), bool)
    opens[0] = True
    opens[1:] = blank[1:] & ~blank[:-1]
    opens[texts.bounds[:-1][np.diff(texts.bounds) > 0]] = True
    start = np.flatnonzero(opens)
    end = np.append(start[1:], len(blank))
    _, pick, kind = np.unique(texts.hashes(start, end), return_index=True, return_inverse=True)

    raw = texts.data[_range(start[pick], (end - start)[pick])]
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.int32).copy()
    codes[codes == 0x20] = _SPACE
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    bounds = lead[np.concatenate([[0], np.cumsum((end - start)[pick])])]
    symbol, found = merge(codes, bounds, vocabulary)

    # single characters: their own piece, else one piece for each byte
    known, ids = vocabulary.single
    alone = np.flatnonzero(found < 0)
    at = np.minimum(np.searchsorted(known, codes[symbol[alone]]), max(len(known) - 1, 0))
    spelled = known[at] == codes[symbol[alone]] if len(known) else np.zeros(len(alone), bool)
    found[alone[spelled]] = ids[at[spelled]]
    rest = alone[~spelled]
    byte_of = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # first byte of each character
    width = np.ones(len(symbol), np.int64)
    width[rest] = (byte_of[1:] - byte_of[:-1])[symbol[rest]]
    place = np.cumsum(width) - width
    flat = np.repeat(found, width).astype(np.int32)
    flat[_range(place[rest], width[rest])] = vocabulary.bytes_at[raw[_range(byte_of[symbol[rest]], width[rest])]]

    edge = np.append(place, len(flat))[np.searchsorted(symbol, bounds)]  # ids of distinct segment i
    count = np.diff(edge)[kind]
    out = flat[_range(edge[:-1][kind], count)]
    upto = np.concatenate([[0], np.cumsum(count)])
    return out, upto[np.searchsorted(start, texts.bounds)]


def decode_texts(ids: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """Texts of id sequences ids[bounds[i]:bounds[i + 1]]; ids outside the vocabulary count for nothing,
    and broken byte sequences give U+FFFD."""
    raw, begin = vocabulary.spelled
    good = (ids >= 0) & (ids < len(vocabulary.pieces))
    safe = np.where(good, ids, 0)
    size = np.where(good, begin[safe + 1] - begin[safe], 0)
    data = raw[_range(begin[safe], size)].tobytes()
    upto = np.concatenate([[0], np.cumsum(size)])[bounds]
    out = []
    for a, b in zip(upto[:-1], upto[1:]):
        text = data[a:b].decode("utf-8", "replace")
        out.append(text[1:] if text.startswith(" ") else text)
    return out


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array), ``n_tokens`` and ``round_trip``: whether decoding the ids
    gives the text again (U+2581 as a space). Own columns of those names are replaced.

    Null and empty texts have no tokens. Texts are encoded whole, whatever their length; repeated rows
    get the same ids; an empty table gives an empty result.
    """
    added = {"token_ids": "array<int>", "n_tokens": "long", "round_trip": "boolean"}
    rows = docs.drop(*added)
    columns = rows.columns
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = encode_texts(part.column(text), shared.value)
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
        again = decode_texts(ids, bounds, shared.value)
        plain = pc.replace_substring(pc.fill_null(part.column(text), ""), chr(_SPACE), " ")
        same = pc.equal(plain, pa.array(again, plain.type))
        return pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(np.diff(bounds)), same], names=[*columns, *added])

    return over_texts(rows, text, work, extended(rows, added), TOGETHER)


def decode(encoded: DataFrame, vocabulary: Vocabulary, name: str = "decoded") -> DataFrame:
    """Rows with ``token_ids`` and their text as one more column; null ids give an empty text."""
    rows = encoded.drop(name)
    columns = rows.columns
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                lists = part.column("token_ids")
                size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ids = pc.fill_null(pc.list_flatten(lists), -1).to_numpy(zero_copy_only=False)
                texts = decode_texts(ids, np.concatenate([[0], np.cumsum(size)]).astype(np.int64), shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*columns, name])

    return in_arrow(rows, run, extended(rows, {name: "string"}))
