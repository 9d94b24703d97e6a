"""URL filter: listed rules, then association rules mined from labelled URLs.

Method: Spark FP-growth mines combinations of URL tokens from labelled URLs. Rules "tokens
imply bad" are pruned by support and confidence, and by dropping a rule that a shorter one
with at least its confidence implies. URLs match by an inverted index: a rule is filed under
its tokens, and a URL matches the rules of which it holds every token.

A listed rule has a host and a path; it fits a URL of that host or a subdomain whose path
starts with the rule's. The longest rule wins. URLs that no listed rule fits get the verdict
of the mined rules: block if any of them matches.

A URL's tokens are its scheme, every label of the host and every suffix of two labels or more,
every path segment that is not a number, every query key, and the depth, ending, digits and
fragment it has. Two steps keep FP-growth small and lose no rule. Tokens that fewer bad URLs
hold than a rule needs go first. Tokens that the same labelled URLs hold, like a label and the
suffix that starts with it, are mined as one: a pruned rule never holds two of them, and
whatever holds for one holds for the others. So a rule is a list of such classes, and a
URL matches if it holds a token of each.

All expressions are native. Only tokens that rules name take part in matching: their number is
at most the mean number of tokens per labelled URL divided by the support, whatever the
size of the tables, so they are collected. Matching runs on the distinct sets of them, and
the rows meet the sets that match by set and a salt, so that one set may hold any share
of the rows.

Defined results: a null URL or one without ``://`` has an empty host and path, and no tokens;
it is allowed. A host longer than host names can be (253) has labels, but no suffixes. Repeated
URLs count each time, repeated tokens of a URL once. Input columns named like the results
give way. Without labelled URLs no rules are mined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.checkpoints import written

#: Share of the labelled URLs that hold a rule's tokens and are bad, and share of bad ones
#: among those that hold its tokens.
SUPPORT = 0.005
CONFIDENCE = 0.4
#: Longest host name of the domain name system, and parts that the rows of one token set go to.
LONGEST_HOST = 253
SALTS = 64
_BAD = "is bad"
RESULTS = ("host", "path", "rule", "verdict")


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


#: Fixed values of the contract.
LISTED = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash, A to Z lowered."""
    found = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, sorted; null without a host."""
    labels = F.filter(F.split(host, r"\."), lambda s: s != "")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    whole = (F.size(labels) > 1) & (F.length(host) <= LONGEST_HOST)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.regexp_extract(url, r"^[\s\S]*?://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda part: F.substring_index(part, "=", 1))
    kinds = [
        F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1)),
        F.concat(F.lit("depth:"), F.least(F.size(segments), F.lit(5)).cast("string")),
        F.when(path.rlike("[0-9]"), F.lit("number")),
        F.concat(F.lit("ending:"), F.nullif(F.regexp_extract(path, r"\.(\w+)$", 1), F.lit(""))),
        F.when(F.instr(url, "#") > 0, F.lit("fragment")),
    ]
    several = F.concat(
        F.array(*kinds),
        F.transform(labels, lambda s: F.concat(F.lit("label:"), s)),
        F.when(whole, suffixes).otherwise(F.array().cast("array<string>")),
        F.transform(
            F.filter(segments, lambda s: s.rlike("[^0-9]")),
            lambda s: F.concat(F.lit("segment:"), s),
        ),
        F.transform(
            F.filter(keys, lambda k: k != ""), lambda k: F.concat(F.lit("key:"), k)
        ),
    )
    return F.when(host != "", F.array_sort(F.array_distinct(F.array_compact(several))))


def listed_rule(host: Column, path: Column, rules: Sequence[Rule] = LISTED) -> Column:
    """The longest rule that fits, as a struct ``rule, verdict``, or null."""
    longest = sorted(rules, key=lambda r: (-len(r.host + r.path), r))
    found = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit(f".{r.host}")))
            & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in longest
    ]
    return F.coalesce(*found)


def parsed(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path`` and internal ``tokens_``."""
    url = F.col(url_col)
    clean = pages.drop(*RESULTS, "tokens_", "salt_", "listed_", "bad_")
    split = clean.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    return split.withColumn("tokens_", tokens_of(url, F.col("host"), F.col("path")))


def classes(known: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``members``: tokens that enough bad URLs hold for a rule, those of the same URLs together.

    ``known`` has ``tokens_`` and a boolean ``bad``. That two tokens have the same URLs is told by
    two sums of 64-bit hashes over the token sets that hold them.
    """
    sets = known.groupBy("tokens_").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("n_bad")
    )
    total = sets.agg(F.sum("n")).first()[0] or 0
    needed = max(1, math.ceil(support * total))
    held = sets.select(
        F.explode("tokens_").alias("token"),
        "n",
        "n_bad",
        F.xxhash64("tokens_").cast("decimal(38,0)").alias("one"),
        F.xxhash64("tokens_", F.lit(1)).cast("decimal(38,0)").alias("other"),
    )
    tokens = held.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("n", "n_bad", "one", "other")])
    return (
        tokens.where(F.col("n_bad") >= needed)
        .groupBy("n", "n_bad", "one", "other")
        .agg(F.array_sort(F.collect_list("token")).alias("members"))
        .select("members")
    )


def mine(
    labelled: DataFrame,
    url_col: str = "url",
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Rules ``tokens, confidence`` from URLs with a boolean ``bad``; null labels don't count.

    ``tokens`` lists classes of tokens; a URL matches if it holds one of each class.
    """
    # Written first: pages and labels are read and joined once.
    known = written(
        parsed(labelled.where("bad IS NOT NULL"), url_col)
        .where("tokens_ IS NOT NULL")
        .select("tokens_", "bad"),
        "url-labelled",
    )
    grouped = written(classes(known, support), "url-classes")
    firsts = [r[0] for r in grouped.select(F.get("members", F.lit(0))).collect()]
    frequent = F.filter("tokens_", lambda t: t.isin(firsts))
    baskets = known.select(
        F.when(F.col("bad"), F.concat(frequent, F.array(F.lit(_BAD))))
        .otherwise(frequent)
        .alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(_BAD))).select(
        F.array_sort("antecedent").alias("tokens"), "confidence"
    )
    # A rule goes if one of its parts is a rule with at least its confidence.
    shorter = rules.select(F.col("tokens").alias("s"), F.col("confidence").alias("c"))
    filed = rules.select("tokens", "confidence", F.explode("tokens").alias("t"))
    held = shorter.select("s", "c", F.explode("s").alias("t"))
    implied = (
        filed.join(held, "t")
        .where((F.size("s") < F.size("tokens")) & (F.col("c") >= F.col("confidence")))
        .groupBy("tokens", "s")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") == F.size("s"))
        .select("tokens")
        .distinct()
    )
    kept = rules.join(implied, "tokens", "left_anti").select(
        "tokens", "confidence", F.explode("tokens").alias("first")
    )
    named = grouped.select(F.get("members", F.lit(0)).alias("first"), "members")
    return written(
        kept.join(named, "first")
        .groupBy("tokens", "confidence")
        .agg(F.array_sort(F.collect_list("members")).alias("classes"))
        .select(F.col("classes").alias("tokens"), "confidence"),
        "url-rules",
    )


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Of the distinct ``tokens_`` those that hold a token of every class of a rule, by
    inverted index."""
    index = rules.select(
        F.col("tokens").alias("rule_"), F.posexplode("tokens").alias("class_", "members_")
    ).select("rule_", "class_", F.explode("members_").alias("token_"))
    return (
        token_sets.select("tokens_", F.explode("tokens_").alias("token_"))
        .join(index, "token_")
        .groupBy("tokens_", "rule_")
        .agg(F.count_distinct("class_").alias("n"))
        .where(F.col("n") == F.size("rule_"))
        .select("tokens_")
        .distinct()
    )


def judge(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", listed: Sequence[Rule] = LISTED
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (of the list, or null) and ``verdict``."""
    in_rules = rules.select(F.explode(F.flatten("tokens")).alias("token")).distinct().collect()
    named = F.filter("tokens_", lambda t: t.isin([r.token for r in in_rules]))
    known = (
        parsed(pages, url_col)
        .withColumn("listed_", listed_rule(F.col("host"), F.col("path"), listed))
        .withColumn("tokens_", F.when(F.col("listed_").isNull(), named))
        .withColumn("tokens_", F.when(F.size("tokens_") > 0, F.col("tokens_")))
    )
    open_sets = known.where("tokens_ IS NOT NULL").select("tokens_").distinct()
    salts = F.expr(f"explode(sequence(0L, {SALTS - 1}L))")
    bad = matched(open_sets, rules).select(
        "tokens_", salts.alias("salt_"), F.lit(True).alias("bad_")
    )
    return (
        known.withColumn("salt_", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        .join(bad, ["tokens_", "salt_"], "left")
        .withColumn("rule", F.col("listed_.rule"))
        .withColumn(
            "verdict",
            F.coalesce("listed_.verdict", F.when(F.col("bad_"), "block").otherwise("allow")),
        )
        .drop("tokens_", "salt_", "listed_", "bad_")
    )


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """URLs whose path ends in the number of a labelled document; bad: low quality or toxic."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:/|\.\w+)?$", 1)
    bad = (F.col("quality") == 0) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    verdicts = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(bad).alias("bad"))
    )
    named = pages.select("url", number.alias("number_")).select(
        "url", F.expr("try_cast(number_ AS bigint)").alias("doc_id")
    )
    return named.join(verdicts, "doc_id").select("url", "bad")
