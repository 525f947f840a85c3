"""Not-modified revisits of a web archive resolved to the response they repeat.

Records are (record_id, kind, url, at, headers, payload digest).  A revisit is
joined as of its time to the latest earlier full response of the same canonical
URL; its validators are checked against that response's; and the headers that a
not-modified answer may update are merged over the stored ones.

The as-of join holds under any skew of URLs: records are range-partitioned by
(URL, time, id), so a URL with a third of all records is spread over many
partitions; each partition carries its last full response forward, and the last
one of every earlier partition (one row per URL and partition) fills the rest.

A revisit's ``status``: ``resolved``; ``mismatch``, the latest earlier response
has another validator; ``missing``, there is none.  The first of these that
both sides have decides: entity tag (weak comparison), Last-Modified, payload
digest; without any the revisit is ``unchecked`` and its headers are not merged.
Records of equal time are in order of record_id.  A record without a URL or a
time is never matched.  Header names are put in lower case first; of names that
differ in case alone the last entry stands.  Null headers count as none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import checkpoint

# fixed values: header fields that a 304 answer updates (RFC 9110, section 15.4.5)
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without user, default port, fragment;
    empty path as ``/``; query fields sorted."""
    part = lambda n: F.regexp_extract(
        url, r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(\?[^#]*)?", n)
    scheme, host, path, query = F.lower(part(1)), F.lower(part(2)), part(3), part(4)
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(
        scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    fields = F.array_join(F.array_sort(F.split(F.substring(query, 2, F.length(query)), "&")), "&")
    return F.when(scheme == "", url).otherwise(F.concat(
        scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path),
        F.when(F.length(query) > 1, F.concat(F.lit("?"), fields)).otherwise("")))


def parse_headers(block: Column) -> Column:
    """An HTTP header block as ``map<string,string>``: names in lower case,
    of repeated names the last, lines without a colon left out."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\r?\n"), lambda x: F.instr(x, ":") > 1)
    pairs = F.transform(lines, lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("key"),
        F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value")))
    return _last_of_each(pairs)


def _last_of_each(pairs: Column) -> Column:
    """A map of ``array<struct<key,value>>`` that keeps the last of equal keys."""
    return F.aggregate(pairs, F.expr("cast(map() as map<string,string>)"), lambda m, p: F.map_concat(
        F.map_filter(m, lambda k, _: k != p["key"]), F.create_map(p["key"], p["value"])))


def lower_names(headers: Column) -> Column:
    """The header map with its names in lower case."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    mixed = F.exists(F.map_keys(headers), lambda k: k != F.lower(k))
    return F.when(mixed, _last_of_each(pairs)).otherwise(headers)


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(record_id, url_key, kind, status, source_id, digest, headers) of every
    record of ``records(record_id, kind, url, at, headers, digest)``; kind is
    ``response`` or ``revisit``, others pass through as ``status`` null."""
    r = records.select("record_id", "kind", canonical_url(F.col("url")).alias("url_key"), "at",
                       lower_names(F.coalesce("headers", F.expr("cast(map() as map<string,string>)"))).alias("headers"),
                       "digest")
    spread = r.repartitionByRange("url_key", "at", "record_id").withColumn("part", F.spark_partition_id())
    spread = checkpoint(spread)  # fixes the partition numbers for both uses below
    full = F.when((F.col("kind") == "response") & F.col("url_key").isNotNull() & F.col("at").isNotNull(),
                  F.struct(F.col("record_id").alias("id"), "headers", "digest"))
    inside = Window.partitionBy("url_key", "part").orderBy("at", "record_id").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = spread.withColumn("near", F.last(full, ignorenulls=True).over(inside))
    # maps have no order, so the latest response is taken with its headers as entries
    tails = (spread.filter(full.isNotNull()).groupBy("url_key", "part")
             .agg(F.max(F.struct("at", "record_id", F.map_entries("headers").alias("entries"), "digest")).alias("t"))
             .select("url_key", "part", F.struct(F.col("t.record_id").alias("id"),
                                                 F.map_from_entries("t.entries").alias("headers"), "t.digest").alias("tail")))
    # a URL has a row per partition here, so the window is over few rows
    parts = spread.select("url_key", "part").distinct().join(tails, ["url_key", "part"], "left")
    across = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (parts.select(F.col("url_key").alias("k"), F.col("part").alias("p"),
                           F.last("tail", ignorenulls=True).over(across).alias("far")).filter("far IS NOT NULL"))
    joined = carried.join(before, (F.col("url_key") == F.col("k")) & (F.col("part") == F.col("p")), "left")
    source = F.coalesce("near", "far")
    usable = F.col("url_key").isNotNull() & F.col("at").isNotNull()
    joined = joined.withColumn("source", F.when((F.col("kind") == "revisit") & usable, source))

    own, old = F.col("headers"), F.col("source.headers")
    both = lambda a, b: a.isNotNull() & b.isNotNull()
    same = (F.when(both(_tag(own), _tag(old)), _tag(own) == _tag(old))
            .when(both(own["last-modified"], old["last-modified"]), own["last-modified"] == old["last-modified"])
            .when(both(F.col("digest"), F.col("source.digest")), F.col("digest") == F.col("source.digest")))
    status = (F.when(F.col("kind") == "response", "full")
              .when(F.col("kind") == "revisit",
                    F.when(F.col("source").isNull(), "missing").when(same.isNull(), "unchecked")
                    .when(same, "resolved").otherwise("mismatch")))
    update = F.map_filter(own, lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
    return joined.withColumn("status", status).select(
        "record_id", "url_key", "kind", "status",
        F.when(F.col("status") != "missing", F.col("source.id")).alias("source_id"),
        F.when(F.col("status") == "resolved", F.col("source.digest"))
        .when(F.col("kind") == "response", F.col("digest")).alias("digest"),
        F.when(F.col("status") == "resolved", merged).otherwise(own).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records of the ``pages`` table: each page is captured four times,
    a day apart, in an order and with answers that its id decides.  The header
    blocks are written out and parsed as those of an archive are."""
    p = pages.select("page_id", "url", F.sha2("html", 256).alias("sha"), F.length("html").alias("size"),
                     F.explode(F.array(*map(F.lit, range(4)))).alias("k"))
    id_, k = F.col("page_id"), F.col("k")
    full = (k == id_ % 3) | ((k == 3) & (id_ % 5 == 0))
    version = F.when(k == 3, F.lit("b")).otherwise("a")
    tag = F.concat(F.substring("sha", 1, 12), version)
    answer = F.when((id_ + k) % 4 == 0, "").otherwise(F.concat(
        F.lit("ETag: W/\""), F.when(id_ % 7 == 0, F.lit("old")).otherwise(F.concat(F.substring("sha", 1, 12), F.lit("a"))),
        F.lit("\"\r\n")))
    block = F.when(full, F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nCache-Control: max-age=60\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit("\r\nETag: \""), tag, F.lit("\"\r\nX-Hop: "), k.cast("string"))).otherwise(
        F.concat(F.lit("HTTP/1.1 304 Not Modified\r\nCache-Control: max-age="), (60 * k).cast("string"),
                 F.lit("\r\n"), answer, F.lit("X-Hop: "), k.cast("string")))
    return p.select((4 * id_ + k).alias("record_id"), F.when(full, "response").otherwise("revisit").alias("kind"), "url",
                    ((id_ % 10) * 3600 + 86400 * k.cast("long")).alias("at"), parse_headers(block).alias("headers"),
                    F.when(full | (id_ % 11 != 0), F.concat(F.lit("sha256:"), F.col("sha"))).alias("digest"))


def op3_warc(pages: DataFrame) -> DataFrame:
    out = resolve_revisits(captures(pages))
    written = F.array_join(F.array_sort(F.transform(
        F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"]))), "\n")
    return out.select("record_id", "url_key", "kind", "status", "source_id", "digest", written.alias("headers"))


def op3_sql() -> str:
    return r"""
    WITH cap AS (
      SELECT page_id, url, sha256(html) AS sha, length(html) AS size, k FROM pages, range(4) r(k)),
    rec AS (
      SELECT 4 * page_id + k AS record_id, (k = page_id % 3 OR (k = 3 AND page_id % 5 = 0)) AS full_,
             url, (page_id % 10) * 3600 + 86400 * k AS ts, page_id, k, sha, size,
             regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(\?[^#]*)?',
                            ['s', 'h', 'p', 'q']) AS u FROM cap),
    rows_ AS (
      SELECT record_id, full_, ts, CASE WHEN full_ THEN 'response' ELSE 'revisit' END AS kind,
             CASE WHEN url IS NULL OR u.s = '' THEN url ELSE
               lower(u.s) || '://' || CASE lower(u.s) WHEN 'http' THEN regexp_replace(lower(u.h), ':80$', '')
                 WHEN 'https' THEN regexp_replace(lower(u.h), ':443$', '') ELSE lower(u.h) END
               || CASE WHEN u.p = '' THEN '/' ELSE u.p END
               || CASE WHEN length(u.q) > 1 THEN '?' || array_to_string(list_sort(string_split(substr(u.q, 2), '&')), '&')
                  ELSE '' END END AS url_key,
             CASE WHEN full_ OR page_id % 11 <> 0 THEN 'sha256:' || sha END AS digest,
             CASE WHEN full_ THEN '"' || substr(sha, 1, 12) || CASE WHEN k = 3 THEN 'b' ELSE 'a' END || '"'
                  WHEN (page_id + k) % 4 <> 0 THEN 'W/"' || CASE WHEN page_id % 7 = 0 THEN 'old' ELSE substr(sha, 1, 12) || 'a' END || '"'
             END AS etag,
             CASE WHEN full_ THEN 'max-age=60' ELSE 'max-age=' || (60 * k) END AS cc,
             CASE WHEN full_ THEN size END AS len, k AS hop FROM rec),
    asof_ AS (
      SELECT *, CASE WHEN NOT full_ AND url_key IS NOT NULL THEN
        last_value(CASE WHEN full_ THEN {'id': record_id, 'etag': etag, 'len': len, 'hop': hop, 'digest': digest} END IGNORE NULLS)
        OVER (PARTITION BY url_key ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS src FROM rows_),
    judged AS (
      SELECT *, CASE WHEN full_ THEN 'full' WHEN src IS NULL THEN 'missing'
        WHEN etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') = src.etag THEN 'resolved' ELSE 'mismatch' END
        WHEN digest IS NULL THEN 'unchecked'
        WHEN digest = src.digest THEN 'resolved' ELSE 'mismatch' END AS status FROM asof_)
    SELECT record_id, url_key, kind, status, src.id AS source_id,
           CASE WHEN status = 'resolved' THEN src.digest WHEN full_ THEN digest END AS digest,
           'cache-control: ' || cc
           || CASE WHEN status = 'resolved' THEN chr(10) || 'content-length: ' || src.len || chr(10) || 'content-type: text/html'
                   WHEN full_ THEN chr(10) || 'content-length: ' || len || chr(10) || 'content-type: text/html' ELSE '' END
           || coalesce(chr(10) || 'etag: ' || coalesce(etag, CASE WHEN status = 'resolved' THEN src.etag END), '')
           || chr(10) || 'x-hop: ' || CASE WHEN status = 'resolved' THEN src.hop ELSE hop END AS headers
    FROM judged"""
