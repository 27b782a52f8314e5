"""Secret scan: fixed patterns, and strings in a sensitive context that zstandard finds novel.

A candidate is a long token, or the value behind a token's first = sign, close after a sensitive word;
the name before = may be that word. Letters of one case, digits and special characters all count, but
not names and words, the pieces of which are short, and mail addresses. Its novelty is the
number of compressed bytes it adds to the code around it, with a dictionary of identifiers primed
beforehand: bytes(context + candidate) - bytes(context). A name that the code or the dictionary
already holds costs a few bytes; a random string costs nearly its information content. Candidates at
``NOVELTY`` compressed bytes per character or more are reported as ``novel``; letters of one case need
``ONE_CASE_NOVELTY``, since rare words are nearly as novel.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import extended, in_arrow, over_texts, slices

KINDS = ["assign", "access", "hex", "novel"]
#: Characters on either side of a candidate that count as its surroundings.
CONTEXT = 160
#: Characters after a sensitive word in which a candidate may begin.
REACH = 64
#: Compressed bytes per character from which a candidate is novel (random hex digits carry 0.5).
NOVELTY = 0.45
#: The same for candidates without digits that are no more than letters of one case in a row.
ONE_CASE_NOVELTY = 0.65
#: Identifiers in the dictionary: the most frequent ones of all sensitive contexts.
DICTIONARY_SIZE = 2_000
#: Distinct identifiers that a task counts before it hands them on.
FLUSH = 50_000

# fixed values: the patterns to report
_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_LEAST, _ACCESS_LEAST = 8, 16
# end of fixed values

_SENSITIVE = re.compile(r"(?i:key|secret|token|passw|pwd|auth|credential|bearer|private)", re.ASCII)
_SENSITIVE_WORDS = ["key", "secret", "token", "passw", "pwd", "auth", "credential", "bearer", "private"]
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.!@#$%^&*~-]{8,}")
_LETTER, _DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")
_CASES = re.compile(r"[a-z](?=[A-Z])|[A-Z](?=[a-z])")
#: Changes of case per letter from which a token without digits is no word or camelCase name.
CASES = 0.4
# special characters with something on either side
_SPECIAL = re.compile(r"(?<=.)[!@#$%^&*~](?=.)")
#: Special characters from which a token is no word, whatever its letters.
SPECIALS = 2
#: Letters of one case in a row from which a token may be a secret: hardly any word has so many.
ONE_CASE = 20
_ONE_CASE = re.compile(rf"[a-z]{{{ONE_CASE},}}|[A-Z]{{{ONE_CASE},}}")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a name and the separator before its value; = at the end is padding
_NAMED = re.compile(r"[A-Za-z0-9/_.-]+=+(?=[^=])")
#: Characters of the shortest candidate, and of the shortest value after a name; digits in a row of the
#: shortest number.
LEAST_TOKEN, LEAST_VALUE, LEAST_NUMBER = 16, 8, 16
_NUMBER = re.compile(rf"[0-9]{{{LEAST_NUMBER},}}")
_IDENTIFIER = re.compile(r"[A-Za-z_]{4,40}")

SPAN = "struct<kind:string,start:int,end:int,secret_start:int>"


def base_spans(text: str, sensitive: bool = True) -> list[tuple[str, int, int, int]]:
    """Pattern matches (kind, start, end, start of the secret itself), ordered by start, then kind.
    Positions are code points. ``sensitive``: whether an assignment is possible at all."""
    found = []
    if sensitive:
        found += [
            ("assign", *m.span(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _ASSIGN_LEAST
        ]
    if "AKIA" in text:
        found += [
            ("access", *m.span(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _ACCESS_LEAST
        ]
    found += [("hex", *m.span(), m.start()) for m in _HEX.finditer(text)]
    return _ordered(found)


def _ordered(spans):
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def is_sensitive(text: str) -> bool:
    low = text.lower()
    return any(word in low for word in _SENSITIVE_WORDS)


def is_wordy(token: str) -> bool:
    """Whether a token looks like words or a name: no digits, few special characters and changes of case."""
    if _DIGIT.search(token) or len(_SPECIAL.findall(token)) >= SPECIALS:
        return False
    return len(_CASES.findall(token)) < CASES * len(_LETTER.findall(token))


def is_possible(token: str, named: bool = False) -> bool:
    """Whether a token may be a secret at all, which its novelty then decides. A value after a name needs
    a letter only; without a letter, or in words, a long enough run of digits or letters of one case."""
    if _ADDRESS.fullmatch(token):
        return False
    if not _LETTER.search(token):
        return bool(_NUMBER.search(token)) or len(_SPECIAL.findall(token)) >= SPECIALS and bool(_DIGIT.search(token))
    return named or not is_wordy(token) or bool(_ONE_CASE.search(token))


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of long tokens, or of values in name=value, that begin within ``REACH`` characters after a
    sensitive word and may be secrets. Marks that frame a token or end a sentence are not part of it."""
    reach = -1
    found, marks = [], _SENSITIVE.finditer(text)
    mark = next(marks, None)
    for m in _CANDIDATE.finditer(text):
        start, end, least = m.start(), m.end(), LEAST_TOKEN
        name = _NAMED.match(m.group())
        if name:
            start, least = start + name.end(), LEAST_VALUE
        while end - start >= least and text[start] == text[end - 1] and text[start] in "*#~_":
            start, end = start + 1, end - 1
        if text[end - 1] in ".!" and (end == len(text) or text[end].isspace()):
            end -= 1
        while mark is not None and mark.end() <= start:
            reach, mark = mark.end() + REACH, next(marks, None)
        if end - start >= least and start <= reach and is_possible(text[start:end], bool(name)):
            found.append((start, end))
    return found


def novelty_needed(token: str, named: bool, least: float = NOVELTY) -> float:
    """Compressed bytes per character from which a candidate is reported."""
    return max(least, ONE_CASE_NOVELTY) if not named and _LETTER.search(token) and is_wordy(token) else least


def surroundings(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]


class Novelty:
    """Marginal compressed size against a dictionary of identifiers."""

    def __init__(self, identifiers: list[str]):
        primed = None
        if identifiers:  # the most frequent last, where references are cheapest
            raw = " ".join(reversed(identifiers)).encode()
            primed = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=3)
        self._compressor = zstandard.ZstdCompressor(
            level=3, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def __call__(self, before: str, candidate: str, after: str) -> float:
        around = (before + after + " ").encode("utf-8", "surrogatepass")
        added = len(self._compressor.compress(around + candidate.encode())) - len(self._compressor.compress(around))
        return added / len(candidate)


def identifiers(docs: DataFrame, size: int = DICTIONARY_SIZE) -> list[str]:
    """The ``size`` most frequent identifiers (words of letters and underscores, none that may be a secret)
    around the candidates of all documents; ties by name."""

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    if not text or not is_sensitive(text):
                        continue
                    for start, end in candidates(text):
                        for side in surroundings(text, start, end):
                            seen.update(x for x in _IDENTIFIER.findall(side) if not is_possible(x))
                    if len(seen) >= FLUSH:
                        yield _counted(seen)
                        seen = Counter()
        yield _counted(seen)

    counts = in_arrow(docs.select("text"), count, "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    return [r["name"] for r in counts.orderBy(F.desc("n"), "name").limit(size).collect()]


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["name", "n"]
    )


def spans_of(text: str, novelty: Novelty, least: float = NOVELTY) -> list[tuple[str, int, int, int]]:
    """All spans of one whole text. A candidate that touches a pattern match is not reported twice."""
    sensitive = is_sensitive(text)
    base = base_spans(text, sensitive)
    if not sensitive:
        return base
    more = []
    for start, end in candidates(text):
        if any(s < end and start < e for _, s, e, _ in base):
            continue
        before, after = surroundings(text, start, end)
        named = start > 0 and text[start - 1] == "="
        if novelty(before, text[start:end], after) >= novelty_needed(text[start:end], named, least):
            more.append(("novel", start, end, start))
    return _ordered(base + more)


def scan(docs: DataFrame, least: float = NOVELTY, dictionary: int = DICTIONARY_SIZE) -> DataFrame:
    """``docs`` with a column ``spans``: array of (kind, start, end, secret_start), ordered by start,
    then kind as in ``KINDS``. An own column of that name is replaced.

    Null and empty texts have no spans; repeated rows get the same spans; an empty table gives an
    empty result. Texts are scanned whole, whatever their length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(identifiers(docs, dictionary))  # bounded names
    rows = docs.drop("spans")
    columns = rows.columns

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        novelty = _novelty(shared.value)
        found = [
            [dict(zip(("kind", "start", "end", "secret_start"), s)) for s in spans_of(text or "", novelty, least)]
            for text in part.column("text").to_pylist()
        ]
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("secret_start", pa.int32())])
        )
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(found, kind)], names=[*columns, "spans"])

    return over_texts(rows, "text", work, extended(rows, {"spans": f"array<{SPAN}>"}))


_made: dict[tuple, Novelty] = {}


def _novelty(names: list[str]) -> Novelty:
    key = (len(names), hash(tuple(names)))
    if key not in _made:
        _made.clear()
        _made[key] = Novelty(names)
    return _made[key]


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the pattern matches, a checksum of their spans, and all spans as text."""

    def shown(kinds: list[str]):
        chosen = F.filter("spans", lambda s: s["kind"].isin(kinds))
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(shown(KINDS[:3]).cast("binary"), 256).alias("base_sha256"), shown(KINDS).alias("spans"),
    )


def redacted(scanned: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows without ``spans``; every secret in ``text`` is replaced by ``mark`` and a column
    ``n_chars`` follows the new text. Overlapping secrets become one mark. Rows without spans stay."""
    names = [c for c in scanned.columns if c != "spans"]

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
            out, at = [], 0
            for start, end in sorted((s["secret_start"], s["end"]) for s in spans or []):
                if start >= at:
                    out += [text[at:start], mark]
                at = max(at, end)
            texts.append("".join([*out, text[at:]]) if out else text)
        columns = {name: part.column(name) for name in names}
        columns["text"] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    out = over_texts(scanned, "text", work, scanned.drop("spans").schema)
    if "n_chars" in names:
        length = F.char_length("text").cast(scanned.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out


def checksum(spans: list[tuple[str, int, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans).encode()).hexdigest()
