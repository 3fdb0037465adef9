"""WARC not-modified revisits: each is resolved against the latest earlier full response.

Records are (record_id, url, time, kind, status, validator, headers, payload). A revisit is joined
as of its time with the last full response of the same canonical URL that is strictly earlier, or
of equal time and smaller record id. It is ``resolved`` if both validators are there and equal, or the
revisit has none; ``stale`` if they differ; ``orphan`` if there is no earlier response. A resolved revisit
takes the response's payload, and its headers with those a 304 may replace laid over them.

The as-of join works in time buckets: the last response of each (URL, bucket) is carried forward
over the few buckets, and within a bucket a running last value sees only that bucket's rows, so
a URL with a third of all rows is still dealt to many tasks. Only ids and validators take part; payloads
are fetched by an equi join on the id.

A null or empty URL is a URL of its own ("") and matches only such; a null time comes before all
others; null payloads and headers stay null. Repeated rows stay: of equal (time, id) responses the larger
payload hash is taken, and of records equal in id and payload the headers of least JSON text. Columns beyond the named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Headers that a 304 answer may update.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical(url: Column) -> Column:
    """Lower-case host without scheme, www. and default port; path without a trailing slash; sorted
    query without utm_ parameters; no fragment."""
    u = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, r"^[^/?]*", 0)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    args = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"), lambda a: (a != "") & ~F.lower(a).startswith("utm_")))
    return F.concat(host, path, F.when(F.size(args) > 0, F.concat(F.lit("?"), F.array_join(args, "&"))).otherwise(F.lit("")))


def merge_headers(old: Column, new: Column) -> Column:
    """``old`` with the permitted ones of ``new`` laid over (maps of lower-case names)."""
    take = F.map_filter(F.coalesce(new, F.create_map().cast("map<string,string>")), lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    keep = F.map_filter(F.coalesce(old, F.create_map().cast("map<string,string>")), lambda k, v: ~F.array_contains(F.map_keys(take), k))
    return F.map_concat(keep, take)


def resolve(records: DataFrame, bucket_seconds: int = 6 * 3600) -> DataFrame:
    """Every revisit record with outcome, response_id, status, headers and payload."""
    r = records.select("record_id", canonical(F.col("url")).alias("curl"), "time", "kind", "status", "validator", "headers", "payload")
    full = F.col("kind") == "response"
    order = F.struct(F.coalesce(F.col("time").cast("timestamp").cast("double"), F.lit(float("-inf"))).alias("t"), F.col("record_id").alias("id"))
    slim = r.where(full | (F.col("kind") == "revisit")).select("record_id", "curl", "kind", "validator", order.alias("at"), F.when(full, F.xxhash64("payload")).alias("ph"))
    slim = slim.withColumn("bucket", F.when(F.col("at.t") == float("-inf"), F.lit(-(2**62))).otherwise(F.floor(F.col("at.t") / bucket_seconds)))
    found = F.when(F.col("kind") == "response", F.struct("at", "ph", "record_id", "validator"))
    last = slim.groupBy("curl", "bucket").agg(F.max(found).alias("last"))
    carried = last.select(F.col("curl").alias("c"), F.col("bucket").alias("b"), F.last("last", ignorenulls=True).over(Window.partitionBy("curl").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = F.last(found, ignorenulls=True).over(Window.partitionBy("curl", "bucket").orderBy("at", F.when(F.col("kind") == "response", 1).otherwise(0), "ph").rowsBetween(Window.unboundedPreceding, -1))
    seen = slim.withColumn("inside", inside).where(F.col("kind") == "revisit")
    seen = seen.join(carried, (seen.curl == carried.c) & (seen.bucket == carried.b), "left").withColumn("hit", F.coalesce("inside", "before"))
    outcome = F.when(F.col("hit").isNull(), "orphan").when(F.col("validator").isNull() | (F.col("validator") == F.col("hit.validator")), "resolved").otherwise("stale")
    seen = seen.select("record_id", "curl", outcome.alias("outcome"), F.col("hit.record_id").alias("response_id"), F.col("hit.ph").alias("ph"))
    # of repeated records, the headers of least JSON text and their status
    rank = F.struct(F.coalesce(F.to_json("headers"), F.lit("")).alias("h"), F.coalesce("status", F.lit(-1)).alias("s"))
    body = r.where(full).select(F.col("record_id").alias("rid"), F.xxhash64("payload").alias("rph"), "headers", "status", "payload", rank.alias("rank"))
    body = body.groupBy("rid", "rph").agg(F.min_by("headers", "rank").alias("old"), F.min("payload").alias("payload"), F.min_by("status", "rank").alias("old_status"))
    own = r.where(F.col("kind") == "revisit").withColumn("rank", rank).groupBy(F.col("record_id").alias("vid")).agg(F.min_by("headers", "rank").alias("new"))
    out = seen.join(own, seen.record_id.eqNullSafe(F.col("vid")), "left").join(body, (F.col("response_id") == F.col("rid")) & (F.col("ph") == F.col("rph")) & (F.col("outcome") == "resolved"), "left")
    return out.select("record_id", "curl", "outcome", "response_id", F.col("old_status").alias("status"), F.when(F.col("outcome") == "resolved", merge_headers(F.col("old"), F.col("new"))).alias("headers"), "payload")


def crawl_log(pages: DataFrame) -> DataFrame:
    """The pages as a crawl: page k is fetched in full k minutes after the epoch, with its html's md5 as
    validator, and asked for again a day later with that validator, not modified."""
    t = F.timestamp_seconds(F.col("page_id") * 60)
    tag = F.md5(F.coalesce(F.col("html"), F.lit("")))
    base = pages.select("page_id", "url", "html", t.alias("t"), tag.alias("tag"))
    first = base.select((F.col("page_id") * 2).alias("record_id"), "url", F.col("t").alias("time"), F.lit("response").alias("kind"), F.lit(200).alias("status"), F.col("tag").alias("validator"), F.create_map(F.lit("etag"), F.col("tag"), F.lit("content-type"), F.lit("text/html"), F.lit("date"), F.col("t").cast("string")).alias("headers"), F.col("html").alias("payload"))
    again = base.select((F.col("page_id") * 2 + 1).alias("record_id"), "url", F.timestamp_seconds(F.col("page_id") * 60 + 86400).alias("time"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), F.col("tag").alias("validator"), F.create_map(F.lit("etag"), F.col("tag"), F.lit("content-length"), F.lit("0"), F.lit("date"), F.timestamp_seconds(F.col("page_id") * 60 + 86400).cast("string")).alias("headers"), F.lit(None).cast("string").alias("payload"))
    return first.unionByName(again)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve(crawl_log(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    return out.select("record_id", F.col("curl").alias("canonical_url"), "outcome", "response_id", "status", F.md5("payload").alias("payload_md5"), F.element_at("headers", "date").alias("date"), F.element_at("headers", "content-type").alias("content_type"), F.element_at("headers", "content-length").alias("content_length"))


ORACLE = r"""
WITH p AS (
  SELECT page_id, html, md5(coalesce(html, '')) AS tag,
    regexp_replace(regexp_replace(trim(coalesce(url, '')), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages),
q AS (
  SELECT page_id, html, tag,
    regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*', 0)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
    list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda a: a <> '' AND NOT starts_with(lower(a), 'utm_'))) AS args FROM p),
c AS (SELECT page_id, html, tag, base || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS curl FROM q),
resp AS (SELECT page_id * 2 AS rid, page_id * 60 AS t, curl, tag, html FROM c),
rev AS (SELECT page_id * 2 + 1 AS record_id, page_id * 60 + 86400 AS t, curl, tag FROM c),
j AS (SELECT v.record_id, v.curl, v.tag, v.t, max(struct_pack(t := r.t, rid := r.rid)) AS hit
      FROM rev v LEFT JOIN resp r ON r.curl = v.curl AND (r.t < v.t OR (r.t = v.t AND r.rid < v.record_id)) GROUP BY ALL)
SELECT j.record_id, j.curl AS canonical_url,
  CASE WHEN j.hit.rid IS NULL THEN 'orphan' WHEN j.tag = r.tag THEN 'resolved' ELSE 'stale' END AS outcome,
  j.hit.rid AS response_id, CASE WHEN j.tag = r.tag THEN 200 END AS status,
  CASE WHEN j.tag = r.tag THEN md5(r.html) END AS payload_md5,
  CASE WHEN j.tag = r.tag THEN strftime(make_timestamp(j.t * 1000000), '%Y-%m-%d %H:%M:%S') END AS date,
  CASE WHEN j.tag = r.tag THEN 'text/html' END AS content_type, CAST(NULL AS VARCHAR) AS content_length
FROM j LEFT JOIN resp r ON r.rid = j.hit.rid
"""
