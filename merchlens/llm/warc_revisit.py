"""Not-modified revisits of a crawl, resolved to the full responses that they refer to.

A revisit says that a page had not changed. It is joined, as of its own time, to the
latest earlier full response of its canonical URL; the validators of both must agree, and
of the revisit's headers only those that such an answer may update are taken over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.asof import latest_before

# Header fields that a 304 answer may renew; query fields that only track.
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(?:utm_[a-z]+|fbclid|gclid|dclid|msclkid|mc_[ce]id|ref|sessionid|sid|phpsessid)(?:=|$)"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without user, default port, fragment, tracking
    fields and a final slash, and with the query fields in order; null stays null."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.regexp_replace(plain, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"\.?(?::(?:80|443)?)?$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    fields = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&", -1)
    kept = F.array_sort(F.filter(fields, lambda f: (f != "") & ~F.lower(f).rlike(TRACKING)))
    scheme = F.when(scheme.isin("", "https"), "http").otherwise(scheme)
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.concat_ws("&", kept))).otherwise("")
    return F.concat(scheme, F.lit("://"), host, path, query)


def _tag(etag: Column) -> Column:
    """An entity tag without its mark of weakness."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, canonical, at, outcome, refers_to, headers``.

    ``records`` has ``record_id, url, at`` (a long), ``kind`` (``response`` or
    ``revisit``) and ``headers`` (a map with names in lower case; null counts as empty).
    ``outcome`` is ``resolved`` if the entity tags agree, weak marks aside, or, where
    either has none, the dates of last change; ``changed`` if they differ, ``unchecked``
    if neither can be compared, ``missing`` if there is no earlier response. Only
    resolved revisits have ``refers_to`` and the response's headers, renewed by those the
    revisit may renew. Responses at the same time as the revisit are not earlier; of
    responses at one time the greatest id counts. Records without URL or time, or of
    another kind, resolve nothing; revisits among them are ``missing``. Records that repeat
    are resolved alike, each in a row of its own.
    """
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    headers = F.coalesce(F.col("headers"), empty)
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id",
        canonical_url(F.col("url")).alias("canonical"),
        F.col("at").cast("long").alias("at"),
        "kind",
        headers.alias("own"),
    )
    pairs = F.array_sort(F.map_entries("own"))
    offer = F.when(
        F.col("kind") == "response", F.struct("at", "record_id", pairs.alias("headers"))
    )
    rows = latest_before(rows.withColumn("met", offer), ["canonical"], "at", "met")
    rows = rows.where("kind = 'revisit'").withColumn("theirs", F.map_from_entries("met.headers"))
    etags = [_tag(F.col(c)["etag"]) for c in ("own", "theirs")]
    dates = [F.trim(F.col(c)["last-modified"]) for c in ("own", "theirs")]
    agree = F.coalesce(etags[0] == etags[1], dates[0] == dates[1])
    outcome = (
        F.when(F.col("met").isNull(), "missing")
        .when(agree, "resolved")
        .when(~agree, "changed")
        .otherwise("unchecked")
    )
    renewed = F.map_filter("own", lambda k, _: k.isin(*RENEWED))
    kept = F.map_filter("theirs", lambda k, _: ~F.map_contains_key(renewed, k))
    resolved = F.col("outcome") == "resolved"
    return rows.withColumn("outcome", outcome).select(
        "record_id",
        "canonical",
        "at",
        "outcome",
        F.when(resolved, F.col("met.record_id")).alias("refers_to"),
        F.when(resolved, F.map_concat(kept, renewed)).alias("headers"),
    )


def records_from_pages(pages: DataFrame) -> DataFrame:
    """Crawl records from stored pages: an id is a time, every third page a revisit.

    A page's entity tag is the digest of its markup, so a revisit is resolved where the
    latest earlier capture of its URL had the same markup. Times are scattered over the
    ids, so that captures of a URL are both before and after its revisits.
    """
    at = F.pmod(F.xxhash64("page_id"), F.lit(1 << 40))
    revisit = F.pmod(F.col("page_id"), F.lit(3)) == 0
    seen = F.concat(F.lit("t"), F.format_string("%013d", at))
    tag = F.concat(F.lit('"'), F.substring(F.sha2(F.coalesce("html", F.lit("")), 256), 1, 16), F.lit('"'))
    common = [F.lit("etag"), tag, F.lit("date"), seen]
    more = F.when(
        revisit, F.create_map(*common, F.lit("content-length"), F.lit("0"))
    ).otherwise(
        F.create_map(
            *common,
            F.lit("content-type"),
            F.lit("text/html"),
            F.lit("content-length"),
            F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
        )
    )
    return pages.select(
        F.col("page_id").alias("record_id"),
        "url",
        at.alias("at"),
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        more.alias("headers"),
    )
