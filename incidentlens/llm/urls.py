"""URL filtering by mined association rules (operator 8).

Labelled URLs become baskets of tokens (scheme, host labels, path segments, query
and fragment words; numbers count as ``#``) and FP-growth finds token combinations
that go with unwanted pages. Rules of enough support and confidence that can't well be
chance, without those that a shorter rule covers, are kept under their rarest token, so
that a URL is compared only with rules whose rarest token it has.

Chance is ruled out by a likelihood ratio test of a rule's confidence against the share
of unwanted URLs, at a level divided by the number of combinations that were looked at:
among thousands of combinations some go with a few unwanted URLs by accident.

Only DataFrame operations are used; the mining is Spark's own.

Defined results: a NULL URL, or one without ``://``, has an empty host and path and
no tokens, and is allowed; equal URLs get equal verdicts; without labels no rule is
mined; an empty table gives no rows; other columns are not looked at.
"""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlens.sources.scratch import materialise

BLOCK, ALLOW = "block", "allow"
_CLASS = "class="
BROADCAST_RULES = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, marked by where they stand."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]*(?s:(.*))$", 1)
    words = F.split(F.lower(rest), r"[^\p{L}\p{N}.]+")
    words = F.transform(words, lambda w: F.regexp_replace(w, r"^\d+", "#"))
    host = F.transform(F.split(host_of(url), r"[.-]+"), lambda w: F.concat(F.lit("host:"), w))
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))))
    found = F.array_distinct(F.concat(scheme, host, F.array_remove(words, "")))
    return F.when(F.instr(url, "://") > 0, found).otherwise(F.array().cast("array<string>"))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule of (verdict, host, path) and its verdict; else NULL."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def significance(matched: Column, unwanted: Column, share: Column) -> Column:
    """Twice the log-likelihood ratio of ``unwanted`` among ``matched`` against their share of all.

    Its chance to exceed x by accident is about exp(-x / 2).
    """

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (part(unwanted, matched * share) + part(matched - unwanted, matched * (1 - share)))


def mine(labelled: DataFrame, support: float = 0.005, confidence: float = 0.8, level: float = 0.05) -> DataFrame:
    """Rules (id, tokens, key token, confidence, support) for unwanted URLs.

    ``labelled`` has ``url`` and boolean ``unwanted``. The number of rules depends
    on the support and the length of URLs, not on the number of rows. ``level`` is the
    chance that any rule is kept though none of the tokens tells anything.
    """
    spark = labelled.sparkSession
    schema = "rule_id long, tokens array<string>, confidence double, support double, key string"
    kind = F.concat(F.lit(_CLASS), F.when(F.col("unwanted"), BLOCK).otherwise(ALLOW))
    baskets = labelled.where("unwanted IS NOT NULL").select(tokens_of(F.col("url")).alias("tokens"), kind.alias("kind"))
    baskets = materialise(
        baskets.where(F.size("tokens") > 0).select(F.concat("tokens", F.array("kind")).alias("items")), "baskets"
    )
    if baskets.isEmpty():
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0] == _CLASS + BLOCK).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support"
    )
    # Rules are few, and the counts are one row each.
    is_unwanted = F.array_contains("items", _CLASS + BLOCK)
    share = baskets.agg(F.avg(is_unwanted.cast("double")).alias("share"), F.count("*").alias("rows"))
    looked_at = model.freqItemsets.where(~F.exists("items", lambda i: i.startswith(_CLASS))).agg(F.count("*").alias("tests"))
    unwanted = F.round(F.col("support") * F.col("rows"))
    least = 2 * F.log(F.col("tests") / level)
    chosen = rules.join(F.broadcast(share), F.lit(True)).join(F.broadcast(looked_at), F.lit(True)).where(
        (F.col("confidence") > F.col("share"))
        & (significance(F.round(unwanted / F.col("confidence")), unwanted, F.col("share")) >= least)
    )
    rules = materialise(chosen.select("tokens", "confidence", "support"), "rules")
    parts = F.transform("tokens", lambda t: F.filter("tokens", lambda o: o != t))
    covered = rules.select("tokens", F.col("confidence").alias("own"), F.explode(parts).alias("shorter")).join(
        rules.select(F.col("tokens").alias("shorter"), "confidence"), "shorter"
    )
    kept = rules.join(covered.where("confidence >= own").select("tokens"), "tokens", "left_anti")
    uses = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    keys = (
        kept.select("tokens", F.explode("tokens").alias("token"))
        .join(uses, "token")
        .groupBy("tokens")
        .agg(F.min(F.struct("freq", "token"))["token"].alias("key"))
    )
    return materialise(
        kept.join(keys, "tokens")
        .select(F.xxhash64("tokens").alias("rule_id"), "tokens", "confidence", "support", "key"),
        "index",
    )


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct URLs that have all tokens of a mined rule."""
    index = rules.select(F.col("key").alias("token"), F.col("tokens").alias("needed"))
    if rules.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    tokens = urls.select("url").distinct().select("url", tokens_of(F.col("url")).alias("tokens"))
    return (
        tokens.select("url", "tokens", F.explode("tokens").alias("token"))
        .join(index, "token")
        .where(F.size(F.array_except("needed", "tokens")) == 0)
        .select("url")
        .distinct()
    )


def judged(
    pages: DataFrame, mined: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Key, host, path, fitting rule and verdict of every page."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    found = matched(rows.where("url IS NOT NULL"), mined).withColumn("is_matched", F.lit(True))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = rows.join(found, "url", "left").select("key", "is_matched", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("is_matched"), BLOCK).otherwise(ALLOW)
    return rows.select(
        F.col("key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict")
    )
