"""Not-modified revisits of web archives, resolved to the response that they confirm.

A crawler that is told "not modified" writes a revisit without payload. It is joined as of its time to the latest earlier
full response of the same canonical URL. The validators decide whether that response is confirmed: the entity tag if the
revisit has one (compared weakly, without ``W/``), else the date of last modification, else the payload digest. The headers of
a confirmed response are those stored, updated by those that a not-modified answer may change.

The as-of join is a window by URL and slice of time. Slices are cut at quantiles of all times, so a URL with very many
captures is spread over them; what a slice starts with is the last response of the slices before, of which there is one row
per URL and slice. Only record ids, validators and headers are moved; payloads are joined by record id where wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers of a not-modified answer that replace those stored (fixed by the HTTP caching rules).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(utm_[a-z]+|fbclid|gclid)(=|$)"
SLICES = 64


def canonical_url(url: Column) -> Column:
    """Host in small letters without ``www.`` and default port, path without trailing slash, sorted query without tracking parameters.

    Scheme and fragment do not count. Null for null.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))


def merged_headers(stored: Column, fresh: Column, permitted: tuple[str, ...] = PERMITTED) -> Column:
    """Stored headers, replaced by the permitted ones of the fresh answer. Names are in small letters."""
    new = F.map_filter(F.coalesce(fresh, F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*permitted))
    old = F.map_filter(F.coalesce(stored, F.create_map().cast("map<string,string>")), lambda k, v: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(old, new)


def latest_response(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """Add ``found``, the latest earlier response (record_id, etag, last_modified, digest, headers) of the same ``key``.

    Order is by ``at`` and record_id. Rows without key or time find nothing.
    """
    usable = records.where("key IS NOT NULL AND at IS NOT NULL")
    fractions = [i / slices for i in range(1, slices)] or [0.5]
    cuts = sorted(set(usable.agg(F.percentile_approx("at", fractions, 10_000)).first()[0] or []))
    cut = F.array(*(F.lit(c).cast("bigint") for c in cuts)) if cuts else F.array().cast("array<bigint>")
    sliced = usable.withColumn("slice", F.size(F.filter(cut, lambda c: c <= F.col("at"))))
    full = F.when(F.col("kind") == "response", F.struct("record_id", "etag", "last_modified", "digest", "headers"))
    last = sliced.where("kind = 'response'").groupBy("key", "slice").agg(F.max_by(full, F.struct("at", "record_id")).alias("last"))
    used = sliced.select("key", "slice").distinct().join(last, ["key", "slice"], "left")
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = used.select("key", "slice", F.last("last", ignorenulls=True).over(before).alias("carried"))
    within = Window.partitionBy("key", "slice").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    found = sliced.withColumn("own", F.last(full, ignorenulls=True).over(within)).join(carried, ["key", "slice"])
    found = found.withColumn("found", F.coalesce("own", "carried")).select(*records.columns, "found")
    nothing = records.where("key IS NULL OR at IS NULL").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
    return found.unionByName(nothing)


def resolve_revisits(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """Resolve the revisits among capture records.

    ``records`` has record_id, url, at (bigint), kind ("response" or "revisit"), etag, last_modified, digest and headers (map);
    other columns are ignored. One row per revisit: record_id, key (canonical URL), outcome, resolved_id and headers.
    The outcome is etag, last_modified or digest (the validator that agreed), "changed" (it did not agree), "unchecked" (the
    revisit has no validator) or "missing" (no earlier response, or no URL or time). Only an agreed one has a resolved_id
    and headers. Repeated rows are resolved one by one; of responses at one time the larger record_id is the later one.
    """
    rows = records.select("record_id", F.col("at").cast("bigint").alias("at"), "kind", "etag", "last_modified", "digest", "headers", canonical_url(F.col("url")).alias("key"))
    found = latest_response(rows, slices).where("kind = 'revisit'")
    strong = lambda tag: F.regexp_replace(tag, r"^W/", "")
    pairs = [("etag", strong(F.col("etag")), strong(F.col("found.etag"))), *((c, F.col(c), F.col(f"found.{c}")) for c in ("last_modified", "digest"))]
    outcome = F.when(F.col("found").isNull(), "missing")
    for name, mine, theirs in pairs:
        outcome = outcome.when(mine.isNotNull(), F.when(mine == theirs, name).otherwise("changed"))
    out = found.withColumn("outcome", outcome.otherwise("unchecked"))
    agreed = F.col("outcome").isin("etag", "last_modified", "digest")
    return out.select(
        "record_id",
        "key",
        "outcome",
        F.when(agreed, F.col("found.record_id")).alias("resolved_id"),
        F.when(agreed, merged_headers(F.col("found.headers"), F.col("headers"))).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Capture records of the table of pages: a response of every page, and a later revisit through another spelling of its URL.

    The kind of validator goes round by page_id: a tag that has changed, a date, a weak tag, a digest, a tag.
    """
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    tag, day = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"')), F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    text = lambda c: c.cast("string")
    age = lambda n: F.concat(F.lit("max-age="), text(F.col("page_id") % n))
    base = pages.select("page_id", "url", digest.alias("digest"), tag.alias("tag"), day.alias("day"), F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes"), age(100).alias("old_age"), age(7).alias("new_age"))
    response = base.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        F.col("page_id").alias("at"),
        F.lit("response").alias("kind"),
        F.col("tag").alias("etag"),
        F.col("day").alias("last_modified"),
        "digest",
        F.create_map(F.lit("cache-control"), F.col("old_age"), F.lit("content-length"), text(F.col("bytes")), F.lit("content-type"), F.lit("text/html")).alias("headers"),
    )
    turn = F.col("page_id") % 5
    revisit = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        F.concat(F.regexp_replace("url", r"^https?://([^/]*)", "HTTPS://www.$1:443"), F.lit("#again")).alias("url"),
        (F.col("page_id") + 1 + F.col("page_id") % 50).alias("at"),
        F.lit("revisit").alias("kind"),
        F.when(turn == 0, F.lit('"other"')).when(turn == 2, F.concat(F.lit("W/"), F.col("tag"))).when(turn == 4, F.col("tag")).alias("etag"),
        F.when(turn == 1, F.col("day")).alias("last_modified"),
        F.when(turn == 3, F.col("digest")).alias("digest"),
        F.create_map(F.lit("cache-control"), F.col("new_age"), F.lit("content-length"), F.lit("0"), F.lit("server"), F.lit("edge")).alias("headers"),
    )
    return response.unionByName(revisit)


#: DuckDB SQL for the rows of the query.
ORACLE_SQL = r"""
WITH base AS (
    SELECT page_id, url, sha256(coalesce(html, '')) AS digest, '"' || sha256(coalesce(html, ''))[1:16] || '"' AS tag,
           'day ' || (page_id % 28) AS day, strlen(coalesce(html, '')) AS bytes
    FROM pages
), spelled AS (
    SELECT page_id * 2 AS record_id, url, page_id AS at, 'response' AS kind, tag AS etag, day AS last_modified, digest,
           'max-age=' || (page_id % 100) AS cache_control, bytes FROM base
    UNION ALL
    SELECT page_id * 2 + 1, regexp_replace(url, '^https?://([^/]*)', 'HTTPS://www.\1:443') || '#again', page_id + 1 + page_id % 50, 'revisit',
           CASE page_id % 5 WHEN 0 THEN '"other"' WHEN 2 THEN 'W/' || tag WHEN 4 THEN tag END,
           CASE page_id % 5 WHEN 1 THEN day END, CASE page_id % 5 WHEN 3 THEN digest END, 'max-age=' || (page_id % 7), 0 FROM base
), bare AS (
    SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM spelled
), cut AS (
    SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '') AS host,
           regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
           list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
                     lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid)(=|$)'))) AS query
    FROM bare
), records AS (
    SELECT *, host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS key FROM cut
), matched AS (
    SELECT v.record_id, v.key, v.etag, v.last_modified, v.digest, v.cache_control, r.record_id AS r_id, r.etag AS r_etag,
           r.last_modified AS r_modified, r.digest AS r_digest, r.bytes,
           row_number() OVER (PARTITION BY v.record_id ORDER BY r.at DESC, r.record_id DESC) AS n
    FROM records v LEFT JOIN records r
      ON r.kind = 'response' AND r.key = v.key AND (r.at < v.at OR r.at = v.at AND r.record_id < v.record_id)
    WHERE v.kind = 'revisit'
), judged AS (
    SELECT *, CASE WHEN r_id IS NULL THEN 'missing'
        WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = r_etag THEN 'etag' ELSE 'changed' END
        WHEN last_modified IS NOT NULL THEN CASE WHEN last_modified = r_modified THEN 'last_modified' ELSE 'changed' END
        WHEN digest IS NOT NULL THEN CASE WHEN digest = r_digest THEN 'digest' ELSE 'changed' END
        ELSE 'unchecked' END AS outcome
    FROM matched WHERE n = 1
)
SELECT record_id, key, outcome, CASE WHEN agreed THEN r_id END AS resolved_id, CASE WHEN agreed THEN cache_control END AS cache_control,
       CASE WHEN agreed THEN CAST(bytes AS VARCHAR) END AS content_length, CASE WHEN agreed THEN 'text/html' END AS content_type,
       CAST(NULL AS VARCHAR) AS server
FROM (SELECT *, outcome IN ('etag', 'last_modified', 'digest') AS agreed FROM judged)
"""
