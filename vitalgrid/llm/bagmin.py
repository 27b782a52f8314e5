"""Near-duplicate classes by BagMinHash: weighted-Jaccard signatures of word-shingle multisets.

A text is a multiset of five-word shingles, its weights the counts. Every shingle owns Poisson
processes over its discretised weight levels (0,1], (1,2], (2,4], (4,8], ...: a range of width v sends
points at rate v to each of the ``SIGNATURE`` registers, and a point counts for a text if its level is
covered by the shingle's weight there. The processes depend on the shingle alone, so two texts agree
in a register with probability sum(min) / sum(max) of their weights. Points come in order of time and
stop once no register can change, so the work hardly depends on the text's length or its weights.

Registers are hashed in bands; texts that share a band are candidates and are verified exactly by the
overlap of their multisets. Copies collapse first. A bucket's members are compared with its most
central text, the one whose bands are the most common, which joins a true group without pairing its
members; buckets that still hold several classes try more central texts. What then shares a bucket
across classes goes through an exact prefix filter on its rarest shingles, bounded by their positions,
so that no link between classes is lost and what many texts have in common pairs nobody. Classes are
the connected components of the verified links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import Texts, bloom, clean_columns, free_name, maybe_in, mix, over_texts
from vitalgrid.session import stored

SHINGLE = 5
SIMILARITY = 0.8
#: Candidates share a band; two texts of similarity 0.8 share none with probability 5e-5.
BANDS, ROWS = 25, 5
SIGNATURE = BANDS * ROWS
#: Central texts that a bucket with several classes tries.
MORE_LEADERS = 8
#: Text bytes whose signatures are made together.
TOGETHER = 200_000

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


def multisets(texts: Texts, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, shingle hash and count of every distinct shingle, ordered by text."""
    doc, value = texts.words.shingles(n)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n: int, m: int = SIGNATURE) -> np.ndarray:
    """BagMinHash of ``n`` multisets given as (set, item hash, weight >= 1): n x m register values.
    Sets without items get zeros."""
    # one process per item and dyadic range of levels that its weight reaches into
    shells = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    of = np.repeat(np.arange(len(doc)), shells)
    shell = np.arange(len(of)) - np.repeat(np.cumsum(shells) - shells, shells)
    low = np.where(shell == 0, 0, 1 << np.maximum(shell - 1, 0))
    width = np.where(shell <= 1, 1, 1 << np.maximum(shell - 1, 0))
    owner, reach = doc[of], weight[of] - low  # levels of the range that the weight covers
    seed = mix(item[of] + shell.astype(_U) * _GOLD)

    total = np.bincount(doc, weight, minlength=n)
    limit = (np.log(m) + 3) / np.maximum(total, 1)
    out = np.zeros(n * m, _U)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        chosen = np.zeros(n, bool)
        chosen[todo] = True
        use = np.flatnonzero(chosen[owner])
        first = np.full(n * m, np.inf)
        who = np.zeros(n * m, _U)
        clock, step, block = np.zeros(len(use)), 0, 4
        while len(use):
            number = np.arange(step + 1, step + block + 1, dtype=_U)
            draw = mix(seed[use][:, None] + number * _GOLD)
            gap = -np.log(((draw >> _U(32)).astype(np.float64) + 1) / 2.0**32) / (m * width[use])[:, None]
            time = clock[:, None] + np.cumsum(gap, axis=1)
            more = mix(draw)
            register = ((more >> _U(40)) * _U(m) >> _U(24)).astype(np.int64)
            level = ((more & _U(0xFFFFFF)) * width[use].astype(_U)[:, None] >> _U(24)).astype(np.int64)
            good = (time <= limit[owner[use]][:, None]) & (level < reach[use][:, None])
            cell = (owner[use][:, None] * m + register)[good]
            when, name = time[good], draw[good]
            np.minimum.at(first, cell, when)
            won = first[cell] == when
            who[cell[won]] = name[won]
            clock = time[:, -1]
            alive = clock <= limit[owner[use]]
            use, clock = use[alive], clock[alive]
            step, block = step + block, min(block * 2, 256)
        filled = np.isfinite(first).reshape(n, m).all(axis=1)
        done = todo[filled[todo]]
        cells = (done[:, None] * m + np.arange(m)).ravel()
        out[cells] = who[cells]
        todo = todo[~filled[todo]]
        limit[todo] *= 2  # a register without a point: look at later points, too
    return out.reshape(n, m)


def overlap(a: Texts, b: Texts, n: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity, sum(min) / sum(max), of the shingle multisets of a[i] and b[i]."""
    sides = [multisets(t, n) for t in (a, b)]
    keys = [mix(value ^ mix(doc.astype(_U) + _GOLD)) for doc, value, _ in sides]
    _, i, j = np.intersect1d(*keys, assume_unique=True, return_indices=True)
    common = np.minimum(sides[0][2][i], sides[1][2][j])
    shared = np.bincount(sides[0][0][i], common, minlength=len(a))
    sizes = sum(np.bincount(doc, count, minlength=len(a)) for doc, _, count in sides)
    return shared / np.maximum(sizes - shared, 1)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, 128-bit fingerprint of the word sequence (k1, k2), weight and band hashes of every row
    that has a word and an id."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts.of(part.column("text"))
        words, n = texts.words, len(texts)
        place = np.arange(len(words.doc), dtype=_U) - words.first[words.doc].astype(_U)
        keys = []
        for salt in (_U(1), _U(2)):
            terms = mix(words.hash + mix(place * _GOLD + salt))
            sums = np.zeros(len(terms) + 1, _U)
            np.cumsum(terms, out=sums[1:])
            keys.append(mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.per_text.astype(_U)).view(np.int64))
        doc, item, weight = multisets(texts)
        found = signatures(doc, item, weight, n).reshape(n, BANDS, ROWS)
        band = np.broadcast_to(np.arange(BANDS, dtype=_U), (n, BANDS))
        for r in range(ROWS):
            band = mix(band * _GOLD + found[:, :, r])
        some = np.flatnonzero(words.per_text)
        flat = pa.array(band[some].view(np.int64).ravel())
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").take(pa.array(some)),
                pa.array(keys[0][some]),
                pa.array(keys[1][some]),
                pa.array(np.bincount(doc, weight, minlength=n)[some].astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), flat),
            ],
            names=["doc_id", "k1", "k2", "weight", "bands"],
        )

    rows = clean_columns(docs, {"doc_id": "long", "text": "string"}).filter("doc_id is not null")
    return over_texts(rows, "text", work, "doc_id long, k1 long, k2 long, weight long, bands array<long>", TOGETHER)


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents with the ids in column ``doc_id``. A Bloom filter of fixed size
    sorts out nearly all others while they are read, so that only few texts are shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom(ids, "doc_id"))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(maybe_in(shared.value, part.column("doc_id").to_numpy().view(_U))))

    rows = clean_columns(docs, {"doc_id": "long", "text": "string"}).filter("doc_id is not null")
    return over_texts(rows, "text", work, "doc_id long, text string").join(ids, "doc_id", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose texts (doc_id, text) overlap by ``similarity`` or more."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        close = overlap(Texts.of(part.column("text_a")), Texts.of(part.column("text_b"))) >= similarity - 1e-12
        return part.select(["a", "b"]).filter(pa.array(close))

    both = (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return over_texts(both, "text_a", work, "a long, b long", TOGETHER).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, root) per linked node other than its root,
    the root being the component's smallest node. Alternates the large-star and small-star steps, each
    a pre-aggregated minimum and a join; every round is written to the shared folder."""
    current = stored(edges.filter("a <> b").distinct(), "links")
    seen = None
    while True:
        both = current.union(current.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        small = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(joined.select("u", "m"))
        current = stored(small.filter("a <> b").distinct(), "links")
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return current.toDF("node", "root")
        seen = state


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row (doc_id, class_id, n_links) per row with an id: ``class_id`` is the smallest doc_id of
    the class, ``n_links`` the verified links of the row's text to different texts that were needed.

    Empty and null texts stand alone. Texts equal up to white space are copies. Rows that share an id
    count as one document, linked by any of its texts. Rows without an id have no class and are left
    out. Texts of fewer than five words are one shingle. An empty table gives an empty result.
    """
    rows = stored(sketches(docs), "sketches")
    nodes = stored(
        rows.groupBy("k1", "k2").agg(
            F.min("doc_id").alias("rep"), F.first("weight").alias("weight"), F.first("bands").alias("bands")
        ),
        "nodes",
    )
    dealt = nodes.select("rep", F.explode("bands").alias("bucket"))
    company = dealt.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    held = stored(dealt.join(company, "bucket"), "buckets")
    fame = held.groupBy("rep").agg(F.sum("size").alias("fame"))  # central texts have the common bands
    weights = nodes.groupBy("rep").agg(F.min("weight").alias("least"), F.max("weight").alias("most"))
    members = stored(held.select("bucket", "rep").join(fame.join(weights, "rep"), "rep"), "members")
    texts = stored(texts_of(fame.select(F.col("rep").alias("doc_id")), docs), "texts")

    leaders = members.groupBy("bucket").agg(_first(F.struct("rep", "least", "most")).alias("leader"))
    tried = stored(_with_leaders(members, leaders, similarity), "tried")
    links = stored(verified(tried, texts, similarity), "verified")
    roots = components(links)

    left = _mixed(members, roots)
    if not left.isEmpty():
        ranked = Window.partitionBy("bucket").orderBy(F.desc("fame"), "rep")
        central = left.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= MORE_LEADERS)
        central = central.select("bucket", F.struct("rep", "least", "most", "root").alias("leader"))
        more = _with_leaders(left, central, similarity)
        more = stored(more.join(tried, ["a", "b"], "left_anti"), "tried")
        found = stored(verified(more, texts, similarity), "verified")
        if not found.isEmpty():
            links = links.union(found)
            roots = components(links)
            left = _mixed(members, roots)
        rest = _rare_pairs(left, texts, similarity).join(tried.union(more), ["a", "b"], "left_anti")
        found = stored(verified(stored(rest, "tried"), texts, similarity), "verified")
        if not found.isEmpty():
            links = links.union(found)
            roots = components(links)

    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    named = (
        nodes.select("k1", "k2", "rep")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .join(degree, "rep", "left")
        .select("k1", "k2", F.coalesce("root", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    found = (
        rows.select("doc_id", "k1", "k2")
        .join(named, ["k1", "k2"])
        .groupBy("doc_id")
        .agg(F.min("class_id").alias("class_id"), F.max("n_links").cast("long").alias("n_links"))
    )
    ids = clean_columns(docs, {"doc_id": "long"}).filter("doc_id is not null")
    return ids.join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def _first(value):
    """The value of the most central member; of equals, the one with the smallest id."""
    return F.max_by(value, F.struct(F.col("fame"), -F.col("rep")))


def _with_leaders(members: DataFrame, leaders: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b), a < b, of members and leaders of a bucket whose weights (and classes, where
    they are known) allow a link."""
    pairs = members.join(leaders, "bucket").filter(
        f"rep <> leader.rep and most >= {similarity} * leader.least and leader.most >= {similarity} * least"
    )
    if "root" in members.columns:
        pairs = pairs.filter("root <> leader.root")
    return pairs.select(F.least("rep", "leader.rep").alias("a"), F.greatest("rep", "leader.rep").alias("b")).distinct()


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their classes, of the buckets that hold several."""
    rooted = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "rep"))
    several = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    return stored(rooted.join(several.select("bucket"), "bucket"), "mixed")


def _rare_pairs(left: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs of members of different classes that a link is still possible between, by prefix filtering.

    The shingles of all texts have one order, rarest first. Before the first shingle that two texts share
    nothing is common to them, so their overlap is at most what either text has from there on; a link needs
    an overlap of similarity / (1 + similarity) of both weights together. For the lighter text that leaves
    shingles with at most (1 - similarity) / (1 + similarity) of its weight before them, for the heavier one
    1 - similarity. No pair is lost. A text that differs too much from a template by words of its own has
    only those among them, so what many texts have in common pairs nobody.
    """
    members = left.select("rep", "root").distinct()
    texts = texts.join(members, F.col("doc_id") == F.col("rep"), "left_semi")

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        doc, item, weight = multisets(Texts.of(part.column("text")))
        total = np.bincount(doc, weight, minlength=part.num_rows).astype(np.int64)
        # texts that share an id are told apart by a hash of their shingles
        first = np.searchsorted(doc, np.arange(part.num_rows + 1))
        sums = np.zeros(len(doc) + 1, _U)
        np.cumsum(mix(item ^ mix(weight.astype(_U))), out=sums[1:])
        version = mix(sums[first[1:]] - sums[first[:-1]]).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").take(pa.array(doc)),
                pa.array(version[doc]),
                pa.array(item.view(np.int64)),
                pa.array(weight.astype(np.int32)),
                pa.array(total[doc]),
            ],
            names=["rep", "version", "shingle", "n", "total"],
        )

    schema = "rep long, version long, shingle long, n int, total long"
    items = stored(over_texts(texts, "text", work, schema, TOGETHER).distinct(), "items")
    common = items.groupBy("shingle").agg(F.count("*").alias("texts"))
    rarest = Window.partitionBy("rep", "version", "total").orderBy("texts", "shingle")  # a text's own shingles
    before = F.sum("n").over(rarest.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ranked = items.join(common, "shingle").withColumn("before", before)
    prefix = ranked.filter((F.col("texts") > 1) & (F.col("before") <= (1 - similarity) * F.col("total") + 1e-9))
    prefix = stored(prefix.join(members, "rep").select("rep", "root", "shingle", "total", "before"), "prefixes")
    lighter = prefix.filter(F.col("before") <= (1 - similarity) / (1 + similarity) * F.col("total") + 1e-9)
    x, y = lighter.alias("x"), prefix.alias("y")
    return (
        x.join(y, "shingle")
        .filter(F.expr(f"""
            x.root <> y.root and (x.total < y.total or x.total = y.total and x.rep < y.rep)
            and x.total >= {similarity}D * y.total
            and least(x.total - x.before, y.total - y.before)
                >= {similarity / (1 + similarity)!r}D * (x.total + y.total) - 1e-9D"""))
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct()
    )


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the members of a class other than its first document; of rows equal in id and text
    one stays. Rows without an id stay."""
    name = free_name(docs, "_gone")
    gone = classes(docs, similarity).filter("class_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    known = docs.filter(F.col("doc_id").isNotNull())
    stay = known.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti").dropDuplicates(["doc_id", "text"])
    return stay.unionByName(docs.filter(F.col("doc_id").isNull()))
