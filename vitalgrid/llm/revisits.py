"""Not-modified revisits in web archives: what a 304 capture stands for.

A revisit is joined, by canonical URL, to the latest earlier full response: an as-of join. It is one
ordered pass (the last known response before each row) over rows that carry headers and pointers but
no payload; a URL with a large part of all captures is cut into slices with the carried response as
the only thing that crosses a cut (``vitalgrid.plans.series``). The validators decide whether the
response still holds, and the headers that a 304 may change are merged into the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import clean_columns
from vitalgrid.plans.series import Series

# fixed values: header fields that a not-modified response may update, and tracking parameters
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning"]
TRACKING = "utm_[a-z]+|gclid|fbclid|msclkid|phpsessid|jsessionid|sessionid|sid"
# end of fixed values

URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def canonical_url(url: Column) -> Column:
    """host + path + sorted query: without scheme, user, ``www.``, default ports, fragment, tracking
    parameters and slashes at the end. Text that is no absolute URL is only trimmed; null stays null."""
    part = [None, *[F.regexp_extract(F.trim(url), URL, i) for i in range(1, 6)]]
    host = F.regexp_replace(F.lower(part[2]), r"^www\.", "")
    usual = (part[3] == "") | ((F.lower(part[1]) == "http") & (part[3] == "80")) | (
        (F.lower(part[1]) == "https") & (part[3] == "443")
    )
    port = F.when(usual, "").otherwise(F.concat(F.lit(":"), part[3]))
    path = F.regexp_replace(part[4], "/+$", "")
    kept = F.filter(F.split(part[5], "&"), lambda p: (p != "") & ~F.lower(p).rlike(f"^(?:{TRACKING})(?:=|$)"))
    query = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, port, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(part[1] == "", F.trim(url)).otherwise(whole)


def lower_names(headers: Column) -> Column:
    """Header map with lower-case names; of names that differ in case only, the last entry stays."""
    entries = F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    names = F.transform(entries, lambda e: e["key"])
    last = F.filter(
        entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), e["key"])
    )
    return F.map_from_entries(last)


def _opaque(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^[Ww]/", "")


def resolve(records: DataFrame, permitted: list[str] = PERMITTED) -> DataFrame:
    """One row per revisit: ``record_id, canonical, time, verdict, response_id, digest, status, headers``.

    ``records``: record_id, url, time (any ordered type), type ('response' or 'revisit'), status,
    headers (map) and digest; missing columns count as null, others are ignored. A full response has
    type 'response' and status 200. Verdicts:

    * ``resolved``: ETags match (weak comparison), or, where either side has none, Last-Modified does;
    * ``mismatch``: the validators say that the stored response has changed;
    * ``unverified``: there is a response, but no validator that both sides have;
    * ``no_response``: no earlier full response; also for a null URL or time.

    Resolved rows carry the response's id, digest, status 200 and its headers with the permitted ones
    of the revisit on top; others have nulls there (``response_id`` is given whenever a response was
    found). A response at the same instant is not earlier. Of several responses at one instant the
    largest record_id counts. Repeated rows give repeated results; an empty table gives an empty one.
    """
    kind = dict(records.dtypes).get("time", "timestamp")
    rows = clean_columns(
        records,
        {"record_id": "string", "url": "string", "time": kind, "type": "string", "status": "int",
         "headers": "map<string,string>", "digest": "string"},
    )
    rows = rows.select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), "time", "status", "digest",
        (F.col("type") == "revisit").alias("revisit"),
        (F.col("type").eqNullSafe("response") & F.col("status").eqNullSafe(200)).alias("full"),
        lower_names(F.col("headers")).alias("headers"),
    ).filter("revisit or full")
    stray = rows.filter("revisit and (canonical is null or time is null)")
    placed = rows.filter("canonical is not null and time is not null")

    base = F.when(F.col("full"), F.struct("record_id", "digest", "headers"))
    series = Series.of(placed, ["canonical"], ["time", "full", "record_id"]).known(before={"base": base})
    joined = series.done().filter("revisit").unionByName(stray, allowMissingColumns=True)

    tag, stored_tag = F.col("headers")["etag"], F.col("base.headers")["etag"]
    date, stored_date = F.col("headers")["last-modified"], F.col("base.headers")["last-modified"]
    verdict = (
        F.when(F.col("base").isNull(), "no_response")
        .when(tag.isNotNull() & stored_tag.isNotNull(), F.when(_opaque(tag) == _opaque(stored_tag), "resolved").otherwise("mismatch"))
        .when(date.isNotNull() & stored_date.isNotNull(), F.when(F.trim(date) == F.trim(stored_date), "resolved").otherwise("mismatch"))
        .otherwise("unverified")
    )
    new = F.map_filter("headers", lambda k, v: k.isin(permitted) & v.isNotNull())
    merged = F.map_concat(F.map_filter("base.headers", lambda k, v: ~F.map_contains_key(new, k)), new)
    holds = F.col("verdict") == "resolved"
    return joined.withColumn("verdict", verdict).select(
        "record_id", "canonical", "time", "verdict",
        F.col("base.record_id").alias("response_id"),
        F.when(holds, F.col("base.digest")).alias("digest"),
        F.when(holds, F.lit(200)).alias("status"),
        F.when(holds, merged).alias("headers"),
    )


def archive(pages: DataFrame) -> DataFrame:
    """Capture records derived from a table of pages: for each page a full response, and a revisit that
    names the same page by another form of its URL. Most revisits come later with the page's ETag or
    date; some come too early, and some have another ETag."""
    page = F.col("page_id").cast("long")
    rows = pages.select(page.alias("page_id"), "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"))
    strong = F.concat(F.lit('"'), "digest", F.lit('"'))
    day = F.concat(F.lit("day "), (F.col("page_id") % 97).cast("string"))

    def headers(**fields: Column) -> Column:
        pairs = [x for name, value in fields.items() for x in (F.lit(name.replace("_", "-")), value)]
        return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())

    captured = rows.select(
        F.concat(F.lit("response-"), "page_id").alias("record_id"), "url", (F.col("page_id") * 60).alias("time"),
        F.lit("response").alias("type"), F.lit(200).alias("status"),
        headers(Content_Type=F.lit("text/html"), ETag=strong, Last_Modified=day, Cache_Control=F.lit("max-age=60")).alias("headers"),
        "digest",
    )
    form = F.col("page_id") % 5
    seen = rows.select(
        F.concat(F.lit("revisit-"), "page_id").alias("record_id"),
        F.concat(F.regexp_replace("url", "^https?://", "HTTPS://"), F.lit("#again")).alias("url"),
        (F.col("page_id") * 60 + F.when(F.col("page_id") % 7 == 0, -5).otherwise(30 + F.col("page_id") % 11 * 6000)).alias("time"),
        F.lit("revisit").alias("type"), F.lit(304).alias("status"),
        headers(
            etag=F.when(form < 3, F.concat(F.lit("W/"), strong)).when(form == 3, F.lit('"other"')),
            last_modified=F.when(form == 4, day),
            expires=F.concat(F.lit("in "), (F.col("page_id") % 13).cast("string")),
            set_cookie=F.lit("no"), content_length=F.lit("0"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return captured.union(seen)
