"""Resolution of not-modified revisits in web captures.

A revisit record (304) has no payload: it refers to the latest earlier full
response of the same canonical URL.  It is resolved if its validators agree with
that response's - its ETag (weak comparison) if both have one, else Last-Modified,
else the payload digest - and then has the response's payload and headers, with
those headers of the 304 merged in that a 304 may update.

The as-of join sorts records by (URL, time) over range partitions; a URL of any
number of captures spreads over as many partitions as it needs.  Each partition
fills forward by itself, and what a partition's last response is reaches the
following ones through one small row per partition.

Defined results (``status`` of each revisit): ``resolved``; ``changed`` if the
validators disagree; ``unvalidated`` if there is no validator both have;
``orphan`` if no earlier full response is known, or the URL or time is null.
Responses at the same time are not earlier; of several equal latest ones the
largest record id counts; repeated records are resolved each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickspark.llm.common import read_table, written

# Headers of a stored response that a 304 must not replace, and
# headers that belong to one connection only.
KEPT_HEADERS = ["content-encoding", "content-length", "content-md5", "content-range", "content-type"]
HOP_HEADERS = ["connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te",
               "trailer", "transfer-encoding", "upgrade"]
# Query parameters that do not name a page.
TRACKING = ["fbclid", "gclid", "mc_cid", "mc_eid", "msclkid", "ref", "sessionid", "utm_campaign", "utm_content",
            "utm_medium", "utm_source", "utm_term"]


def canonical_url(url: Column) -> Column:
    """Host (no www., default port or case), path (no final slashes) and sorted query without tracking."""
    whole = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(whole, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(whole, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    pairs = F.array_sort(F.filter(F.split(F.regexp_extract(whole, "[?](.*)$", 1), "&"),
                                  lambda p: (p != "") & ~F.split(p, "=")[0].isin(TRACKING)))
    query = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise("")
    return F.when(whole.contains("://"), F.concat(host, path, query)).otherwise(whole)


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers, overlaid with those of a 304 that may update them; hop-by-hop headers go."""
    permitted = F.map_filter(F.coalesce(update, F.create_map().cast("map<string,string>")),
                             lambda k, v: ~k.isin(KEPT_HEADERS + HOP_HEADERS))
    rest = F.map_filter(stored, lambda k, v: ~F.map_contains_key(permitted, k) & ~k.isin(HOP_HEADERS))
    return F.map_concat(rest, permitted)


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that then clash, the last counts."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    lowered = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    firsts = F.filter(lowered, lambda e, i: ~F.exists(
        F.slice(lowered, i + 2, F.greatest(F.size(lowered), F.lit(1))), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(firsts)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit of ``records`` with the response it stands for.

    ``records``: record_id, url, ts (seconds), status (200 full response, 304
    revisit; others are neither), headers (map), digest.  Payloads stay where they
    are: ``response_id`` names the record that holds the payload.
    """
    headers = _lower_keys(F.col("headers"))
    rows = records.where(F.col("status").isin(200, 304)).select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("bigint").alias("ts"),
        (F.col("status") == 200).alias("full"), headers.alias("headers"), "digest")
    placeable = rows.where("url_key is not null and ts is not null")
    # at one time revisits come before responses: those are not earlier
    keys = ["url_key", "ts", "full", "record_id"]
    laid = written(written(placeable, "warc-rows").repartitionByRange(*[F.col(k) for k in keys])
                   .sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "warc-laid")
    part = F.shiftright("at", 33)
    response = F.when(F.col("full"), F.struct("record_id", "ts", "headers", "digest"))
    held = laid.withColumn("part", part).withColumn("response", response)
    before = Window.partitionBy("part", "url_key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = held.withColumn("here", F.last("response", ignorenulls=True).over(before))
    # URLs that go on in the next partition: at most two rows per partition
    runs = held.groupBy("url_key", "part").agg(F.max_by("response", F.when(F.col("full"), F.col("at"))).alias("last"))
    spans = held.groupBy("url_key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    earlier = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (runs.join(F.broadcast(spans.select("url_key")), "url_key")
               .withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
               .select("url_key", "part", "carried").where("carried is not null"))
    matched = (local.where("not full").join(F.broadcast(carried), ["url_key", "part"], "left")
               .withColumn("source", F.coalesce("here", "carried"))
               .select("record_id", "url_key", "ts", "headers", "digest", "source"))
    nowhere = rows.where("not full and (url_key is null or ts is null)").select(
        "record_id", "url_key", "ts", "headers", "digest", F.lit(None).cast(matched.schema["source"].dataType).alias("source"))
    return _judged(matched.unionByName(nowhere))


def _judged(matched: DataFrame) -> DataFrame:
    own, stored = F.col("headers"), F.col("source.headers")
    etag, last = (F.try_element_at(own, F.lit("etag")), F.try_element_at(own, F.lit("last-modified")))
    their_etag = F.try_element_at(stored, F.lit("etag"))
    their_last = F.try_element_at(stored, F.lit("last-modified"))
    agrees = (F.when(etag.isNotNull() & their_etag.isNotNull(), _strong(etag) == _strong(their_etag))
              .when(last.isNotNull() & their_last.isNotNull(), last == their_last)
              .otherwise(F.col("digest") == F.col("source.digest")))
    status = (F.when(F.col("source").isNull(), "orphan").when(agrees.isNull(), "unvalidated")
              .when(agrees, "resolved").otherwise("changed"))
    good = status == "resolved"
    return matched.select(
        "record_id", "url_key", "ts", status.alias("status"), F.col("source.record_id").alias("response_id"),
        F.col("source.ts").alias("response_ts"), F.when(good, F.col("source.digest")).alias("payload_digest"),
        F.when(good, merged_headers(stored, own)).alias("headers"))


def captures_from_pages(pages: DataFrame) -> DataFrame:
    """Capture records of the pages table: each page's response, and a later (or too early) 304 of it.

    Times follow the page ids; the 304's URL is written differently, its
    validators take turns: strong and weak ETag, Last-Modified, a stale ETag, digest only.
    """
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    etag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    stamp = F.concat(F.lit("day "), F.floor(F.col("page_id") / 100).cast("string"))
    turn, ts = F.col("page_id") % 5, F.col("page_id") * 60
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", ts.alias("ts"), F.lit(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"),
                     F.length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("ETag"), etag,
                     F.lit("Last-Modified"), stamp, F.lit("Connection"), F.lit("close"), F.lit("Cache-Control"),
                     F.lit("max-age=60")).alias("headers"), digest.alias("digest"))
    common = [F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.concat(F.lit("max-age="), turn.cast("string"))]
    own = (F.when(turn == 0, F.create_map(*common, F.lit("ETag"), etag))
           .when(turn == 1, F.create_map(*common, F.lit("ETag"), F.concat(F.lit("W/"), etag)))
           .when(turn == 2, F.create_map(*common, F.lit("Last-Modified"), stamp))
           .when(turn == 3, F.create_map(*common, F.lit("ETag"), F.lit('"stale"')))
           .otherwise(F.create_map(*common)))
    late = F.when(F.col("page_id") % 11 == 0, F.lit(-30)).otherwise(30 + 3600 * (F.col("page_id") % 7))
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        F.concat(F.regexp_replace("url", "^https?://(www[.])?", "HTTP://"), F.lit("#again")).alias("url"),
        (ts + late).alias("ts"), F.lit(304).alias("status"), own.alias("headers"), digest.alias("digest"))
    return full.unionByName(revisit)


def header_lines(headers: Column) -> Column:
    """'name: value' lines, sorted."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(
        e["key"], F.lit(": "), e["value"]))), "\n")


def op10_warc_revisits(spark, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures_from_pages(read_table(spark, sf_dir, "pages")))
    return found.withColumn("headers", header_lines(F.col("headers")))


_TRACKED = ", ".join(f"'{t}'" for t in TRACKING)
OP10_SQL = f"""
WITH p AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS size,
         '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS etag,
         'day ' || CAST(page_id // 100 AS VARCHAR) AS stamp, page_id % 5 AS turn FROM pages),
c AS (
  SELECT page_id * 2 AS record_id, url, page_id * 60 AS ts, true AS full, digest, size, etag, stamp, turn FROM p
  UNION ALL
  SELECT page_id * 2 + 1, regexp_replace(url, '^https?://(www[.])?', 'HTTP://') || '#again',
         page_id * 60 + CASE WHEN page_id % 11 = 0 THEN -30 ELSE 30 + 3600 * (page_id % 7) END, false, digest, 0,
         CASE turn WHEN 0 THEN etag WHEN 1 THEN 'W/' || etag WHEN 3 THEN '"stale"' END,
         CASE turn WHEN 2 THEN stamp END, turn FROM p),
w AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM c),
k AS (
  SELECT *, CASE WHEN contains(u, '://') THEN
      regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www[.]', ''),
                     ':(80|443)$', '')
      || regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '')
      || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END
    ELSE u END AS url_key
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(u, '[?](.*)$', 1), '&'),
        lambda x: x <> '' AND split_part(x, '=', 1) NOT IN ({_TRACKED}))) AS q FROM w)),
latest AS (
  SELECT v.record_id, max(struct_pack(ts := r.ts, id := r.record_id)) AS top
  FROM k v JOIN k r ON r.url_key = v.url_key AND r.full AND r.ts < v.ts WHERE NOT v.full GROUP BY v.record_id),
m AS (
  SELECT v.record_id, v.url_key, v.ts, v.turn, r.record_id AS response_id, r.ts AS response_ts, r.digest AS theirs,
         r.stamp AS stored_stamp, r.size AS stored_size, r.etag AS stored_etag, v.etag, v.stamp,
         CASE WHEN r.record_id IS NULL THEN 'orphan'
              WHEN CASE WHEN v.etag IS NOT NULL THEN regexp_replace(v.etag, '^W/', '') = r.etag
                        WHEN v.stamp IS NOT NULL THEN v.stamp = r.stamp ELSE v.digest = r.digest END
              THEN 'resolved' ELSE 'changed' END AS status
  FROM k v LEFT JOIN latest l ON l.record_id = v.record_id LEFT JOIN k r ON r.record_id = l.top.id
  WHERE NOT v.full)
SELECT record_id, url_key, ts, status, response_id, response_ts,
       CASE WHEN status = 'resolved' THEN theirs END AS payload_digest,
       CASE WHEN status = 'resolved' THEN array_to_string(list_sort([
         'cache-control: max-age=' || CAST(turn AS VARCHAR), 'content-length: ' || CAST(stored_size AS VARCHAR),
         'content-type: text/html', 'etag: ' || coalesce(etag, stored_etag),
         'last-modified: ' || coalesce(stamp, stored_stamp)]), chr(10)) END AS headers
FROM m
"""
