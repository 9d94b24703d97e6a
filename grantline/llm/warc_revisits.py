"""WARC: resolve "not modified" revisit records against earlier full responses.

Method: an as-of join by canonical URL: a revisit meets the latest full response of its URL
with a smaller time; ties in time by the larger record id. Validators are checked, and the
headers that a 304 may update are merged over those of the response.

Outcomes: ``resolved`` (an entity tag, compared weakly, or else the modification date, or
else the payload digest agrees), ``changed`` (the first of these that both have differs),
``unverified`` (they share none) and ``orphan`` (no earlier response). Headers are merged for
all but orphans.

How it runs. Only keys, times, validators and a hash of the headers enter the as-of join; the
headers of what was found are joined afterwards by URL, time, id and hash, payloads never.
Orphans, which may be most of the revisits, take no part in that join. A URL with a third of all records is split into
periods of ``PERIOD`` seconds: a period's own responses are looked up in a window of that
period, what came before is one row per period, carried forward by a second window.

Defined results: a null URL has no key: its revisits are orphans. A null time is none: such
a response is never found and such a revisit is an orphan. Header names are compared in
lower case. Repeated revisits are resolved each. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 86_400
#: Headers that describe the stored payload and stay as they were, and query
#: keys that name a campaign, not a resource.
KEPT_HEADERS = (
    "connection",
    "content-encoding",
    "content-length",
    "content-md5",
    "content-range",
    "content-type",
    "keep-alive",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
CAMPAIGN = r"^utm_"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, fragment or campaign keys, query keys
    sorted, at least a slash as path. User and password stay as they are."""
    bare = F.substring_index(F.trim(url), "#", 1)
    scheme = F.lower(F.substring_index(bare, "://", 1))
    authority = F.regexp_extract(bare, r"^[^:/?]+://([^/?]*)", 1)
    user = F.regexp_extract(authority, r"^([\s\S]*@)", 1)
    host = F.lower(F.regexp_extract(authority, r"([^@]*)$", 1))
    host = F.regexp_replace(host, F.when(scheme == "https", r":443$").otherwise(r":80$"), F.lit(""))
    path = F.regexp_extract(bare, r"^[^:/?]+://[^/?]*([^?]*)", 1)
    query = F.regexp_extract(bare, r"\?([\s\S]*)$", 1)
    keys = F.filter(F.split(query, "&"), lambda k: (k != "") & ~k.rlike(CAMPAIGN))
    ordered = F.array_join(F.array_sort(keys), "&")
    return F.concat(
        scheme,
        F.lit("://"),
        user,
        host,
        F.when(path == "", "/").otherwise(path),
        F.when(ordered == "", "").otherwise(F.concat(F.lit("?"), ordered)),
    )


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def _outcome() -> Column:
    """First validator that both sides have decides."""
    both = [(_weak(F.col("etag")), _weak(F.col("found.etag")))]
    both += [(F.col(c), F.col(f"found.{c}")) for c in ("last_modified", "digest")]
    agree = F.coalesce(*[a == b for a, b in both])
    return (
        F.when(F.col("found").isNull(), "orphan")
        .when(agree, "resolved")
        .when(~agree, "changed")
        .otherwise("unverified")
    )


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that then agree, the first in order stays."""
    entries = F.array_sort(F.map_entries(headers))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    values = F.transform(
        names, lambda n: F.filter(entries, lambda e: F.lower(e["key"]) == n)[0]["value"]
    )
    return F.map_from_arrays(names, values)


def merged_headers(old: Column, new: Column) -> Column:
    """The response's headers, updated by those a "not modified" answer may change."""
    nothing = F.create_map().cast("map<string,string>")
    old, new = (F.coalesce(_lower_keys(h), nothing) for h in (old, new))
    updates = F.map_filter(new, lambda k, _: ~k.isin(*KEPT_HEADERS))
    rest = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(updates), k))
    return F.map_concat(rest, updates)


def _hash(headers: Column) -> Column:
    return F.xxhash64(F.array_sort(F.map_entries(headers)))


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, url_key, response_id, outcome, headers``.

    ``records`` has ``record_id, url, time`` (seconds), ``revisit`` (boolean), ``etag,
    last_modified, digest`` (text) and ``headers`` (a map).
    """
    keyed = records.select(
        "record_id",
        canonical_url(F.col("url")).alias("url_key"),
        "time",
        "revisit",
        "etag",
        "last_modified",
        "digest",
        F.when(F.col("revisit"), F.col("headers")).alias("new_"),
        F.when(~F.col("revisit"), _hash(F.col("headers"))).alias("hash_"),
        F.floor(F.col("time") / PERIOD).alias("period"),
    )
    response = F.when(
        ~F.col("revisit"), F.struct("time", "record_id", "etag", "last_modified", "digest", "hash_")
    )
    dated = keyed.where("url_key IS NOT NULL AND time IS NOT NULL")
    earlier = Window.partitionBy("url_key", "period").orderBy("time")
    own = F.max(response).over(earlier.rangeBetween(Window.unboundedPreceding, -1))
    periods = dated.groupBy("url_key", "period").agg(F.max(response).alias("newest"))
    before = Window.partitionBy("url_key").orderBy("period")
    newest = F.max("newest").over(before.rowsBetween(Window.unboundedPreceding, -1))
    carried = periods.select("url_key", "period", newest.alias("carried"))
    found = (
        dated.withColumn("own", own)
        .where("revisit")
        .join(carried, ["url_key", "period"])
        .withColumn("found", F.coalesce("own", "carried"))
    )
    none = F.lit(None)
    undated = keyed.where("revisit AND (url_key IS NULL OR time IS NULL)")
    orphans = undated.select("record_id", "url_key").unionByName(
        found.where("found IS NULL").select("record_id", "url_key")
    )
    decided = found.where("found IS NOT NULL").select(
        "record_id", "url_key", "found", _outcome().alias("outcome"), "new_"
    )
    full = records.where("NOT revisit").select(
        canonical_url(F.col("url")).alias("their_url"),
        F.col("time").alias("their_time"),
        F.col("record_id").alias("response_id"),
        _hash(F.col("headers")).alias("their_hash"),
        F.col("headers").alias("old_"),
    ).dropDuplicates(["their_url", "their_time", "response_id", "their_hash"])
    same = (
        (F.col("url_key") == F.col("their_url"))
        & (F.col("found.time") == F.col("their_time"))
        & (F.col("found.hash_") == F.col("their_hash"))
        & F.col("found.record_id").eqNullSafe(F.col("response_id"))
    )
    answered = decided.join(full, same).select(
        "record_id",
        "url_key",
        "response_id",
        "outcome",
        merged_headers(F.col("old_"), F.col("new_")).alias("headers"),
    )
    return answered.unionByName(
        orphans.select(
            "record_id",
            "url_key",
            none.cast("long").alias("response_id"),
            F.lit("orphan").alias("outcome"),
            none.cast("map<string,string>").alias("headers"),
        )
    )
