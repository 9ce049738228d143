"""Not-modified revisits in web archives, resolved to the response they stand for.

A crawler that is told "not modified" stores a revisit record without a body.  For each one
the latest earlier full response of the same canonical URL is found by an as-of join, its
validators are compared, and the body and headers are put together as a cache would.

The as-of join cuts all records, in order of (URL, time), into ranges of nearly equal size:
each range looks back within itself, and for the rest gets the last response of the ranges
before.  A URL with a third of all records is spread over a third of the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafold.operators.joins import broadcast_if_small
from stratafold.workspace import materialise

# The fields a 304 response sends to update a stored one.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that name where a visitor came from.
TRACKING = "^(utm_[a-z_]*|gclid|fbclid|ref)(=|$)"

_URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#\s]*)([^?#\s]*)(?:\?([^#\s]*))?"

# Of parsed records, those that are full responses.
FULL = "record_type = 'response' AND status = 200 AND record_id IS NOT NULL"

RESOLVED, CHANGED, UNVERIFIED, MISSING = "resolved", "changed", "unverified", "missing"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without end slash, sorted query without tracking."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 1)), "^www\\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, _URL, 2), "/+$", "")
    query = F.filter(F.split(F.regexp_extract(url, _URL, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(query), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def parse_http(block: Column) -> Column:
    """A record's HTTP block as a struct: status, headers (name in lower case, value; in order), body.

    What is not HTTP has a NULL status; the body is what follows the first empty line.
    """

    def header(line: Column) -> Column:
        pair = F.split(line, ":", 2)
        return F.struct(F.lower(F.trim(pair[0])).alias("name"), F.trim(pair[1]).alias("value"))

    def parsed(parts: Column, lines: Column) -> Column:
        status = F.regexp_extract(lines[0], r"^HTTP/[0-9.]+ ([0-9]{3})", 1)
        fields = F.filter(F.slice(lines, 2, F.size(lines)), lambda line: F.instr(line, ":") > 1)
        return F.struct(
            F.when(status != "", status.cast("int")).alias("status"),
            F.transform(fields, header).alias("headers"),
            F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("body"),
        )

    # Arrays of one element make variables, which are computed once.
    parts = F.array(F.split(F.coalesce(block, F.lit("")), "\r?\n\r?\n", 2))
    return F.transform(parts, lambda p: F.transform(F.array(F.split(p[0], "\r?\n")), lambda lines: parsed(p, lines))[0])[0]


def _first(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def _agreement(etag: Column, modified: Column, old: Column) -> Column:
    """How a revisit's validators agree with a response's: entity tags weakly, else the date."""

    def bare(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    both_tags = etag.isNotNull() & old["etag"].isNotNull()
    both_dates = modified.isNotNull() & old["modified"].isNotNull()
    agree = F.when(both_tags, bare(etag) == bare(old["etag"])).when(both_dates, modified == old["modified"])
    return F.when(old.isNull(), MISSING).when(agree.isNull(), UNVERIFIED).when(agree, RESOLVED).otherwise(CHANGED)


def merge_headers(stored: Column, update: Column) -> Column:
    """Stored headers with the permitted ones of the update in place of those of the same name."""
    fresh = F.filter(update, lambda h: h["name"].isin(*PERMITTED))
    return F.concat(F.filter(stored, lambda h: ~F.exists(fresh, lambda f: f["name"] == h["name"])), fresh)


def _latest_before(records: DataFrame) -> DataFrame:
    """Each revisit with ``old``, the last full response of its URL before it."""
    order = ["date", "is_response", "record_id"]
    cut = records.repartitionByRange("url", *order).sortWithinPartitions("url", *order)
    ranged = materialise(cut.withColumn("range", F.spark_partition_id()), "warc-ranges")
    # A struct begins with what orders responses of one time.
    response = F.when(F.col("is_response"), F.struct("date", "record_id", "etag", "modified"))
    within = Window.partitionBy("range", "url").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # At one time revisits come first, so they do not see responses of the same time.
    seen = ranged.withColumn("seen", F.last(response, ignorenulls=True).over(within)).filter(~F.col("is_response"))
    before = Window.partitionBy("url").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy("range", "url")
        .agg(F.max(response).alias("last"))
        .withColumn("carried", F.last("last", ignorenulls=True).over(before))
        .select("range", "url", "carried")
    )
    return seen.join(carried, ["range", "url"]).withColumn("old", F.coalesce("seen", "carried"))


def _bodies(kept: DataFrame, parsed: DataFrame) -> DataFrame:
    """(response_id, block) of the responses, one row each: of one that is there again the smallest full one.

    Which ones those are is known from the narrow rows, so all others go straight to the join
    with the revisits, where adaptive execution can split the revisits of one response.
    """
    ids = parsed.filter("record_type = 'response' AND record_id IS NOT NULL").groupBy(F.col("record_id").alias("response_id")).agg(F.count("*").alias("rows"))
    again = materialise(ids.filter("rows > 1").select("response_id"), "warc-again")
    responses = kept.filter((F.col("record_type") == "response") & F.col("record_id").isNotNull())
    responses = responses.select(F.col("record_id").alias("response_id"), "block")
    if again.isEmpty():
        return responses
    status = parse_http(F.col("block"))["status"]
    repeated = responses.join(broadcast_if_small(again), "response_id", "left_semi").filter(status == 200)
    smallest = repeated.groupBy("response_id").agg(F.min("block").alias("block"))
    return responses.join(broadcast_if_small(again), "response_id", "left_anti").unionByName(smallest)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, outcome, response_id, headers, body.

    Records have record_id, record_type (``response`` or ``revisit``), uri, date and block;
    other types and columns are not read.  Full responses have status 200.  ``outcome`` is
    resolved, changed (validators differ), unverified (none to compare) or missing (no
    earlier full response); only resolved ones have headers and body.  Earlier means a
    smaller date; of responses at one time the largest record_id counts.  Without uri or
    date a revisit is missing and a response is never used.  record_id names a record:
    repeated revisits give repeated rows, repeated responses count once, with their smallest block.
    """
    kept = records.filter(F.col("record_type").isin("response", "revisit"))
    # Written without bodies: the ranges below are cut from narrow rows, and blocks are parsed once.
    parsed = materialise(
        kept.select("record_id", "record_type", "uri", "date", parse_http(F.col("block")).alias("http")).select(
            "record_id", "record_type", "uri", "date", F.col("http.status").alias("status"), F.col("http.headers").alias("headers")
        ),
        "warc-headers",
    )
    placed = F.col("uri").isNotNull() & F.col("date").isNotNull()
    narrow = parsed.filter(placed & (F.expr(FULL) | (F.col("record_type") == "revisit"))).select(
        canonical_url(F.col("uri")).alias("url"),
        "date",
        (F.col("record_type") == "response").alias("is_response"),
        "record_id",
        _first(F.col("headers"), "etag").alias("etag"),
        _first(F.col("headers"), "last-modified").alias("modified"),
        F.when(F.col("record_type") == "revisit", F.col("headers")).alias("update"),
    )
    found = materialise(
        _latest_before(narrow).select(
            "record_id",
            _agreement(F.col("etag"), F.col("modified"), F.col("old")).alias("outcome"),
            F.col("old.record_id").alias("response_id"),
            "update",
        ),
        "warc-outcomes",
    )
    resolved = (
        found.filter(F.col("outcome") == RESOLVED)
        .join(_bodies(kept, parsed), "response_id")
        .withColumn("http", parse_http(F.col("block")))
        .select(
            "record_id",
            "outcome",
            "response_id",
            merge_headers(F.col("http.headers"), F.col("update")).alias("headers"),
            F.col("http.body").alias("body"),
        )
    )

    def unresolved(rows: DataFrame, outcome: Column, response_id: Column) -> DataFrame:
        nothing = [F.lit(None).cast(resolved.schema[c].dataType).alias(c) for c in ("headers", "body")]
        return rows.select("record_id", outcome.alias("outcome"), response_id.alias("response_id"), *nothing)

    others = unresolved(found.filter(F.col("outcome") != RESOLVED), F.col("outcome"), F.col("response_id"))
    lost = parsed.filter((F.col("record_type") == "revisit") & ~placed)
    return resolved.unionByName(others).unionByName(unresolved(lost, F.lit(MISSING), F.lit(None).cast("string")))


# A page is captured at the minute of its id and asked for again so many minutes later.
AGAIN = 5_000


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A capture and a later revisit of every page, as archive records.

    Revisits bring an entity tag (every seventh page another one than was stored), every
    fifth page brings the date of modification alone, every eleventh no validator.
    """
    pages = pages.select("page_id", "url", "html", F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"')).alias("tag"))
    tag = F.col("tag")
    modified = F.concat(F.lit("day "), F.col("page_id") % 28)

    def block(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    response = block(
        "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nETag: ", tag, "\r\nLast-Modified: ", modified,
        "\r\nCache-Control: max-age=60\r\nContent-Length: ", F.length("html").cast("string"), "\r\n\r\n", F.col("html"),
    )
    validators = (
        F.when(F.col("page_id") % 11 == 0, F.lit(""))
        .when(F.col("page_id") % 5 == 0, F.concat(F.lit("Last-Modified: "), modified, F.lit("\r\n")))
        .when(F.col("page_id") % 7 == 0, F.lit('ETag: "other"\r\n'))
        .otherwise(F.concat(F.lit("ETag: W/"), tag, F.lit("\r\n")))
    )
    revisit = block("HTTP/1.1 304 Not Modified\r\n", validators, "Cache-Control: max-age=120\r\nContent-Type: none\r\n\r\n")

    def record(kind: str, uri: Column, minute: Column, http: Column) -> Column:
        return F.struct(
            F.concat(F.lit(f"{kind}:"), F.col("page_id").cast("string")).alias("record_id"),
            F.lit(kind).alias("record_type"),
            uri.alias("uri"),
            F.timestamp_seconds(minute * 60).alias("date"),
            http.alias("block"),
        )

    both = F.array(
        record("response", F.col("url"), F.col("page_id"), response),
        record("revisit", F.concat("url", F.lit("#again")), F.col("page_id") + AGAIN, revisit),
    )
    return pages.select(F.explode(both).alias("r")).select("r.*")


def revisit_digest(resolved: DataFrame) -> DataFrame:
    """Ids as numbers, headers as text, and a digest of the body."""

    def number(name: str) -> Column:
        return F.regexp_extract(F.col(name), "[0-9]+", 0).cast("long")

    lines = F.transform(F.array_sort("headers"), lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    return resolved.select(
        number("record_id").alias("page_id"),
        "outcome",
        number("response_id").alias("response_page_id"),
        F.array_join(lines, "\n").alias("headers"),
        F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"),
    )


_SQL_URL = _URL.replace("'", "''")

SQL = f"""
WITH parts AS (
    SELECT page_id, html,
           regexp_replace(lower(regexp_extract(url, '{_SQL_URL}', 1)), '^www\\.|:(80|443)$', '', 'g') AS host,
           regexp_replace(regexp_extract(url, '{_SQL_URL}', 2), '/+$', '') AS path,
           array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '{_SQL_URL}', 3), '&'),
               lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))), '&') AS query
    FROM pages
), p AS (
    SELECT page_id, html, '"' || md5(html) || '"' AS tag, 'day ' || page_id % 28 AS modified,
           host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url
    FROM parts
), matched AS (
    SELECT r.page_id, r.tag AS own_tag, r.modified AS own_modified, o.page_id AS response_page_id, o.tag, o.modified, o.html
    FROM (SELECT *, page_id + {AGAIN} AS minute FROM p) r
    ASOF LEFT JOIN (SELECT *, page_id AS minute FROM p) o ON r.url = o.url AND r.minute > o.minute
), judged AS (
    SELECT *, CASE WHEN response_page_id IS NULL THEN 'missing'
                   WHEN page_id % 11 = 0 THEN 'unverified'
                   WHEN page_id % 5 = 0 THEN CASE WHEN own_modified = modified THEN 'resolved' ELSE 'changed' END
                   WHEN page_id % 7 = 0 OR own_tag <> tag THEN 'changed' ELSE 'resolved' END AS outcome
    FROM matched
)
SELECT page_id, outcome, response_page_id,
       CASE WHEN outcome = 'resolved' THEN
           'cache-control: max-age=120' || chr(10) || 'content-length: ' || length(html) || chr(10)
           || 'content-type: text/html' || chr(10)
           || 'etag: ' || CASE WHEN page_id % 5 = 0 THEN tag ELSE 'W/' || own_tag END || chr(10)
           || 'last-modified: ' || modified END AS headers,
       CASE WHEN outcome = 'resolved' THEN sha256(html) END AS body_sha256
FROM judged
"""
