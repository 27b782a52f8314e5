"""Main text of web pages: host suffix arrays find boilerplate, the rest of the text stays.

Markup tells what can be text: not scripts, forms, menus, footers and the like, and if a page has
article or main elements, only what is in them. On all pages, a host's repeated runs decide about that
text. A task sorts the suffixes of the block streams it has (prefix doubling) and hands on, for every
run of whole blocks of ``RUN`` tokens or more, the smallest and largest page fingerprint; merged by run
with pre-aggregation, those of two distinct pages are repeated, however many tasks a host takes. Pages
that hold repeated runs are grouped into near-copies (min-hash bands, verified). A run on pages of two
groups is boilerplate, so copied articles stay. Blocks in such runs go as a whole; of other blocks go
repeated beginnings and ends of ``LONG`` tokens or more, never what stands in the middle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm import bagmin
from vitalgrid.llm.common import Texts, bloom, clean_columns, maybe_in, mix, over_texts, suffix_order
from vitalgrid.session import stored

#: Tokens of the shortest repeated run of whole blocks that counts as boilerplate.
RUN = 6
#: Tokens of the shortest repeated run that ends or begins inside a block.
LONG = 24
#: Groups of copies that a run stands on at least to be boilerplate; the same inside article and main.
SEVERAL, SEVERAL_MARKED = 2, 3
#: Weighted Jaccard similarity of word shingles from which two pages are copies.
COPY = 0.5
#: Min-hash bands that propose copies; two pages of similarity 0.5 share none with probability 1e-3, of
#: 0.7 with 1e-7.
BANDS, ROWS = 24, 2

# fixed values: element and class names
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style noscript template textarea title iframe svg math object".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output picture "
    "progress q rp rt ruby s samp small span strike strong sub sup time tt u var video audio canvas br img wbr".split()
)
_NOISE_TAGS = set("nav footer aside form menu dialog button select option datalist head".split())
_NOISE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner cookie cookies consent gdpr notice notices "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond disqus share sharing "
    "social related promo promotion sponsor sponsored newsletter subscribe subscription popup modal widget masthead "
    "toolbar pagination pager signup login search skip copyright alert".split()
)
# tags that tell something without any attributes
_SPEAKING = _NOISE_TAGS | {"header", "article", "main"}
_ARTICLE_ROLES = {"main", "article"}
_COMMENT_NAMES = set("comment comments respond disqus".split())
# words that make a class name speak of what is or isn't beside the element
_BESIDE = set("no non not has have with without".split())
# end of fixed values

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z0-9]+")
# no other attributes tell anything about an element
_TELLING = re.compile("class|id|role|itemprop|hidden|style", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in _RAW}
_ENDED_BY_LIKE = set("li dt dd tr td th".split())

NOISE, PLAIN, MAIN, ARTICLE = 0, 1, 2, 3
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_BREAK = np.zeros(256, bool)
_BREAK[0x0A] = True


@dataclass
class _Named:
    """An element whose names say noise, which what it holds may refute."""

    comments: bool
    main: bool = False
    article: bool = False
    size: int = 0
    blocks: int = 0


@dataclass(slots=True)
class _Open:
    """An open element: the zone inside, whether it or one around it is noise, and the named elements up to it."""

    tag: str
    noise: bool
    zone: int
    own: _Named | None
    named: tuple[_Named, ...]


def _noise_names(value: str) -> set[str]:
    """Names of the list that are part of a class, id or role, such as cookie-notice; not of has-sidebar."""
    parts = [set(_NAME.findall(name)) for name in value.split()]
    return _NOISE_NAMES & set().union(*[p for p in parts if not p & _BESIDE])


def _noisy(tag: str, attributes: str, zone: int) -> tuple[bool, int, _Named | None]:
    """Whether an element's content is no article text, the zone it opens, and whether its names alone
    speak against it."""
    named = None
    opened = ARTICLE if tag == "article" else MAIN if tag == "main" else zone
    if tag in _NOISE_TAGS or (tag == "header" and zone == PLAIN):
        return True, opened, None
    if tag in ("html", "body") or not _TELLING.search(attributes):
        return False, opened, None
    for name, double, single, bare in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (double or single or bare).lower()
        if name == "role" and value in _ARTICLE_ROLES:
            opened = max(opened, MAIN)
        elif name == "itemprop" and value == "articlebody":
            opened = ARTICLE
        elif name in ("class", "id", "role"):
            if tag not in ("article", "main") and (names := _noise_names(value)):
                named = _Named(bool(names & _COMMENT_NAMES) or (named is not None and named.comments))
            if tag == "article" and {"comment", "comments"}.intersection(_NAME.findall(value)):
                return True, opened, None
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, opened, None
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return True, opened, None
    return False, opened, named


def _single_spaced(text: str) -> str:
    """Text trimmed, with one space for each run of white space."""
    # white space other than U+0020 isn't printable
    return text.strip(" ") if "  " not in text and text.isprintable() else " ".join(text.split())


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the page's text blocks in order, white space single, references decoded.

    Noise names count for nothing on an element around main, around all article text of the page, or
    (but for comments) around several blocks that are more than half of the page's text.
    """
    found: list[tuple[int, bool, tuple[_Named, ...], str]] = []
    words: list[str] = []
    stack: list[_Open] = []
    base = _Open("", False, PLAIN, None, ())
    inside = base  # the innermost open element
    inlines = False  # whether an inline element was ever put on the stack

    def close() -> None:
        if words:
            text = _single_spaced(words[0] if len(words) == 1 else "".join(words))
            if text:
                found.append((inside.zone, inside.noise, inside.named, text))
            words.clear()

    at, pieces = 0, _PIECE.finditer(page)
    while m := next(pieces, None):
        start, end = m.span()
        if start > at:
            words.append(unescape(page[at:start]))
        at = end
        closing, tag, attributes = m.groups()
        if not tag:
            continue  # a comment or declaration
        tag = tag.lower()
        if tag == "br":
            words.append(" ")
            continue
        inline = tag in _INLINE
        if closing:
            if inline and not inlines:
                continue
            if not inline:
                close()
            if inside.tag == tag:
                depth = len(stack) - 1
            else:
                depth = len(stack) - 2
                while depth >= 0 and stack[depth].tag != tag:
                    depth -= 1
            if depth >= 0:
                if inline:
                    close()
                del stack[depth:]
                inside = stack[-1] if stack else base
            continue
        if tag in _RAW:
            shut = _RAW_END[tag].search(page, at)
            at = shut.end() if shut else len(page)
            pieces = _PIECE.finditer(page, at)
            continue
        if not attributes and tag not in _SPEAKING:
            if inline:
                continue
            is_noise, opened, names = False, inside.zone, None
        else:
            is_noise, opened, names = _noisy(tag, attributes, inside.zone)
        if inline or tag in _VOID:
            if tag == "hr":
                close()
            if (is_noise or names) and tag not in _VOID:
                close()
                named = (*inside.named, names) if names else inside.named
                inside = _Open(tag, inside.noise or is_noise, inside.zone, names, named)
                stack.append(inside)
                inlines = inlines or inline
            continue
        close()
        outer = inside
        while stack and (inside.tag == "p" or (inside.tag == tag and tag in _ENDED_BY_LIKE)):
            stack.pop()
            inside = stack[-1] if stack else base
        if not attributes or not attributes.rstrip().endswith("/"):
            if opened > inside.zone and not is_noise and not outer.noise:
                for x in inside.named:
                    x.main |= opened == MAIN
                    x.article = True
            named = (*inside.named, names) if names else inside.named
            inside = _Open(tag, inside.noise or is_noise, max(opened, inside.zone), names, named)
            stack.append(inside)
    if at < len(page):
        words.append(unescape(page[at:]))
    close()
    return _refuted(found)


def _refuted(found: list[tuple[int, bool, tuple[_Named, ...], str]]) -> list[tuple[int, str]]:
    """(zone, text) of blocks (zone, noise, named elements around, text)."""
    total = 0
    around: dict[int, _Named] = {}
    for _, noise, named, text in found:
        if not noise:
            total += len(text)
        for x in named:
            around[id(x)] = x
            if not noise:
                x.size += len(text)
                x.blocks += 1
    if not around:
        return [(NOISE if noise else zone, text) for zone, noise, _, text in found]

    stand = {i for i, x in around.items() if not (x.main or (x.size * 2 > total and x.blocks > 1 and not x.comments))}
    open_text = any(
        zone > PLAIN and not noise and not (named and any(id(x) in stand for x in named)) for zone, noise, named, _ in found
    )
    out = []
    for zone, noise, named, text in found:
        if named and not noise:
            noise = any(id(x) in stand and (open_text or not x.article or x.comments) for x in named)
        out.append((NOISE if noise else zone, text))
    return out


@dataclass
class _Page:
    """Blocks of a page: all in order, the numbers of those that may be its text, and whether article or
    main markup chose them."""

    blocks: list[str]
    kept: list[int]
    marked: bool

    @property
    def text(self) -> str:
        return "\n".join(self.blocks[i] for i in self.kept)


def settled(page: str) -> _Page:
    """The blocks of a page, and which of them markup leaves as its text: those in article or main
    elements if there are any, else all but what is noise."""
    found = blocks(page)
    zones = [z for z, _ in found]
    best = max(zones, default=NOISE)
    least = MAIN if best > PLAIN else PLAIN
    return _Page([t for _, t in found], [i for i, z in enumerate(zones) if z >= least], best > PLAIN)


def _pages(part: pa.RecordBatch) -> list[_Page]:
    return [settled(h or "") for h in part.column("html").to_pylist()]


def _marks(pages: list[_Page], host: np.ndarray) -> np.ndarray:
    """Fingerprints of pages: host, markup, and the text they may have, or all blocks if they have none."""
    shown = [[p.blocks[i] for i in p.kept] or p.blocks for p in pages]
    texts = Texts.of(pa.array(["\n".join(x) for x in shown], pa.string()))
    salt = host.view(_U) + np.array([p.marked for p in pages], _U)
    return mix(texts.hashes(texts.bounds[:-1], texts.bounds[1:]) + salt).view(np.int64)


def _runs(pages: list[_Page], host: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Runs of the pages that line up with block borders, in the order of suffix arrays: lists of
    (page, run, first block, last block, part, open), equal runs of a host side by side; ``open`` tells
    whether the page's text may have one of the blocks.

    Two suffix arrays, of the host streams of whole blocks and of those streams reversed, give for
    every block the shortest run of whole blocks from or up to it that has ``RUN`` tokens; any longer
    repeated run of whole blocks is made of these. ``part`` is 0 for them. In blocks of more than
    ``LONG`` tokens the first (part > 0) or last (part < 0) ``LONG``, 2 * ``LONG``, ... are runs, too.
    """
    texts = Texts.of(pa.array(["\n".join(p.blocks) for p in pages], pa.string()))
    block, salt = texts.runs(_BREAK), mix(host.view(_U))
    n = len(block.start)
    if not n:
        return []
    page, number = block.doc, np.arange(n) - block.first[block.doc]
    words = texts.words
    low, high = np.searchsorted(words.start, block.start), np.searchsorted(words.start, block.end)
    upto = np.cumsum(high - low)  # tokens before the end of each block
    free = np.zeros(n, bool)
    for i, p in enumerate(pages):
        free[block.first[i] + np.array(p.kept, np.int64)] = True
    frees = np.concatenate([[0], np.cumsum(free)])
    stream = mix(block.hash + salt[page])
    out = []
    for backwards in (False, True):
        if backwards:
            last = np.arange(n)
            first = np.searchsorted(upto - (high - low), upto - RUN, side="right") - 1
            order = (n - 1 - suffix_order(stream[::-1], RUN)).astype(np.int64)
        else:
            first = np.arange(n)
            last = np.searchsorted(upto, upto - (high - low) + RUN)
            order = suffix_order(stream, RUN)
        whole = (first >= 0) & (last < n)
        whole[whole] = page[first[whole]] == page[last[whole]]
        order = order[whole[order]]
        first, last = first[order], last[order]
        run = mix(texts.hashes(block.start[first], block.end[last]) + salt[page[first]])
        out.append((page[first], run, number[first], number[last], np.zeros(len(first), np.int64), frees[last + 1] > frees[first]))
    many = (high - low - 1) // LONG  # shorter than the block
    at = np.repeat(np.arange(n), many)
    size = LONG * (np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + 1)
    for sign, start, end in (
        (1, block.start[at], words.end[low[at] + size - 1]),
        (-1, words.start[high[at] - size], block.end[at]),
    ):
        run = mix(texts.hashes(start, end) + salt[page[at]] + _U(2 + sign))
        order = np.argsort(run, kind="stable")
        out.append((page[at][order], run[order], number[at][order], number[at][order], sign * size[order], free[at][order]))
    return out


def host_of(url: str = "url"):
    """Host of an address without port, user and ``www.``; empty if there is none."""
    bare = F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(bare, r"^www\.", "")


def repeated_runs(pages: DataFrame) -> DataFrame:
    """(run,) for every run that stands on two distinct pages of a host, and in what may be the text of
    one of them at least; the host is part of ``run``."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        host = part.column("host").to_numpy(zero_copy_only=False)
        found = _pages(part)
        mark = _marks(found, host)
        names, lows, highs, opens = [], [], [], []
        for page, run, *_, free in _runs(found, host):
            if len(run):
                first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
                names.append(run[first].view(np.int64))
                lows.append(np.minimum.reduceat(mark[page], first))
                highs.append(np.maximum.reduceat(mark[page], first))
                opens.append(np.logical_or.reduceat(free, first))
        if not names:
            return None
        columns = [pa.array(np.concatenate(x)) for x in (names, lows, highs, opens)]
        return pa.RecordBatch.from_arrays(columns, names=["run", "lo", "hi", "open"])

    local = over_texts(pages, "html", work, "run long, lo long, hi long, open boolean")
    merged = local.groupBy("run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("open").alias("open"))
    return merged.filter("lo < hi and open").select("run")


def _holders(pages: DataFrame, runs: np.ndarray) -> DataFrame:
    """(raw, page, marked, text, buckets, places) of all pages: hash of host and html, fingerprint, and for those
    that hold a run of a Bloom filter, else null, their kind, the text they may have, its min-hash bands, and
    (run, at, part) for each such run and block that may go."""
    shared = pages.sparkSession.sparkContext.broadcast(runs)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        host = part.column("host").to_numpy(zero_copy_only=False)
        found = _pages(part)
        mark = _marks(found, host)
        places: dict[int, set] = {}
        numbers = [{i: at for at, i in enumerate(p.kept)} for p in found]
        for page, run, first, last, size, _ in _runs(found, host):
            hit = maybe_in(shared.value, run)
            for p, r, a, b, n in zip(*(x[hit].tolist() for x in (page, run.view(np.int64), first, last, size))):
                # a run of blocks that cannot go still tells what repeats
                inside = [numbers[p][i] for i in range(a, b + 1) if i in numbers[p]] or [-1]
                places.setdefault(p, set()).update((r, i, n) for i in inside)
        rows = sorted(places)
        texts = pa.array([found[p].text if p in places else None for p in range(len(found))], pa.string())
        buckets = dict(zip(rows, _buckets(Texts.of(texts.take(pa.array(rows, pa.int64()))), host[rows])))
        held = [sorted(places[p]) if p in places else None for p in range(len(found))]
        return pa.RecordBatch.from_arrays(
            [
                part.column("raw"),
                pa.array(mark),
                pa.array([p.marked for p in found], pa.bool_()),
                texts,
                pa.array([buckets.get(p) for p in range(len(found))], pa.list_(pa.int64())),
                pa.array(
                    [x and [dict(zip(("run", "at", "part"), y)) for y in x] for x in held],
                    pa.list_(pa.struct([("run", pa.int64()), ("at", pa.int64()), ("part", pa.int64())])),
                ),
            ],
            names=["raw", "page", "marked", "text", "buckets", "places"],
        )

    places = "array<struct<run:long,at:long,part:long>>"
    return over_texts(
        pages, "html", work, f"raw long, page long, marked boolean, text string, buckets array<long>, places {places}"
    )


def _buckets(texts: Texts, host: np.ndarray) -> np.ndarray:
    """Band hashes of the min-hash signatures of some texts of hosts; -1 for texts without words."""
    doc, value = texts.words.shingles(bagmin.SHINGLE)
    out = np.full((len(texts), BANDS), -1, np.int64)
    some, first = np.unique(doc, return_index=True)
    if len(some):
        for band in range(BANDS):
            total = mix(host[some].view(_U) + _U(band))
            for row in range(ROWS):
                total = mix(total + np.minimum.reduceat(mix(value + _U(1 + band * ROWS + row) * _GOLD), first))
            out[some, band] = total.view(np.int64) & np.int64(0x7FFFFFFFFFFFFFFF)
    return out


def copies(holders: DataFrame) -> DataFrame:
    """(page, root) for pages (page, text, buckets) that belong to a group of near-copies. Links are
    verified, from ``COPY`` of the shingles in common; groups are the connected components. Only the bands that
    pages share, and texts of pages that share one, travel."""
    bands = holders.select("page", F.explode("buckets").alias("bucket")).filter("bucket >= 0")
    shared = bands.groupBy("bucket").agg(F.min("page").alias("a"), F.max("page").alias("_hi")).filter("a < _hi")
    shared = stored(shared, "copy-bands")
    pairs = bands.withColumnRenamed("page", "b").join(shared, "bucket").filter("a < b").select("a", "b").distinct()
    pairs = stored(pairs, "copy-pairs")
    texts = _among(holders.select("page", "text"), bloom(pairs.select("a").union(pairs.select("b")), "a"))
    texts = texts.withColumnRenamed("page", "doc_id").dropDuplicates(["doc_id"])
    links = stored(bagmin.verified(pairs, texts, COPY), "copies")
    return bagmin.components(links).select(F.col("node").alias("page"), "root")


def _among(texts: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The rows of (page, text) whose page may be in a Bloom filter."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(maybe_in(shared.value, part.column("page").to_numpy().view(_U))))

    return over_texts(texts, "text", work, "page long, text string")


def boilerplate(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(page, gone): by fingerprint, the blocks of pages, and parts of blocks (at, part), that lie in runs
    which several pages of the host hold that are no copies of each other: ``SEVERAL``, or ``SEVERAL_MARKED``
    to overrule article and main markup. And (raw, page) of all pages."""
    runs = stored(repeated_runs(pages), "runs")
    named = stored(_holders(pages, bloom(runs, "run")), "holders")
    holders = named.filter("places is not null")
    places = holders.select("page", "marked", F.explode("places").alias("_p")).select("page", "marked", "_p.*").distinct()
    places = places.join(runs, "run").join(copies(holders), "page", "left").withColumn("root", F.coalesce("root", "page"))
    places = stored(places, "places")
    several = places.select("run", "root").distinct().groupBy("run").agg(F.count("*").alias("n")).filter(F.col("n") >= SEVERAL)
    gone = places.join(several, "run").filter((F.col("at") >= 0) & (~F.col("marked") | (F.col("n") >= SEVERAL_MARKED)))
    gone = gone.groupBy("page").agg(F.collect_set(F.struct("at", "part")).alias("gone"))  # bounded by the page
    return gone, named.select("raw", "page")


def remaining(text: str, gone: list) -> str:
    """A page's text without the blocks, and beginnings and ends of blocks, of (at, part)."""
    whole, head, tail = set(), {}, {}
    for at, part in gone:
        if part == 0:
            whole.add(at)
        elif part > 0:
            head[at] = max(head.get(at, 0), part)
        else:
            tail[at] = max(tail.get(at, 0), -part)
    lines = []
    for at, block in enumerate(text.split("\n")):
        if at in head or at in tail:
            tokens = _WORD.findall(block)
            block = " ".join(tokens[head.get(at, 0) : max(head.get(at, 0), len(tokens) - tail.get(at, 0))])
        if at not in whole and block:
            lines.append(block)
    return "\n".join(lines)


_WORD = re.compile("[^\x20\x09-\x0D]+")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    Null or empty html, and pages without any text of their own, give an empty text. A null url or one
    without a host counts as host ''. Repeated rows give the same text each; pages whose text is the
    same, and near-copies, are one page for the search of repeats. An empty table gives an empty result;
    other columns are ignored, whatever their names.
    """
    rows = clean_columns(pages, {"page_id": "long", "url": "string", "html": "string"}).withColumn("host", F.xxhash64(host_of()))
    rows = rows.withColumn("raw", F.xxhash64("host", "html"))
    gone, named = boilerplate(rows.select("raw", "host", "html"))
    found = stored(gone, "boilerplate")
    # pages to mend are told by their raw hash, so that the last pass parses every page once
    shared = pages.sparkSession.sparkContext.broadcast(bloom(named.join(found, "page", "left_semi"), "raw"))

    def split(part: pa.RecordBatch, mend: bool) -> pa.RecordBatch:
        return part.filter(pa.array(maybe_in(shared.value, part.column("raw").to_numpy().view(_U)) == mend))

    def plain(part: pa.RecordBatch) -> pa.RecordBatch:
        part = split(part, False)
        texts = pa.array([p.text for p in _pages(part)], pa.string())
        return pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), texts], names=["page_id", "url", "text"])

    def parse(part: pa.RecordBatch) -> pa.RecordBatch:
        part = split(part, True)
        if not part.num_rows:
            return None
        pages = _pages(part)
        mark = _marks(pages, part.column("host").to_numpy(zero_copy_only=False))
        return pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array([p.text for p in pages], pa.string()), pa.array(mark)],
            names=["page_id", "url", "text", "page"],
        )

    def finish(part: pa.RecordBatch) -> pa.RecordBatch:
        gone = [[(g["at"], g["part"]) for g in x] for x in part.column("gone").to_pylist()]
        texts = [remaining(t, g) for t, g in zip(part.column("text").to_pylist(), gone)]
        return pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )

    result = "page_id long, url string, text string"
    done = over_texts(rows.drop("host"), "html", plain, result)
    none = F.array().cast("array<struct<at:long,part:long>>")
    left = over_texts(rows, "html", parse, f"{result}, page long").join(found, "page", "left").withColumn("gone", F.coalesce("gone", none))
    mended = over_texts(left.drop("page"), "text", finish, result)
    return done.union(mended).withColumn("n_chars", F.char_length("text").cast("long"))
