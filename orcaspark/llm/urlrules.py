"""URL filters from fixed rules and from mined token combinations.

Fixed rules judge a host and its subdomains by the beginning of the path; the longest
wins. The urls they judge are the labelled ones: FP-growth mines combinations of url
tokens that occur with a label. Combinations with enough support and confidence become
association rules, less those that a shorter rule with the same verdict makes needless.
Urls without a fixed rule are matched against them through an inverted index: a rule
fits if all its tokens are found.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orcaspark.llm.common import table
from orcaspark.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class FixedRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    FixedRule("net", "/", "block"),
    FixedRule("example.net", "/en/", "allow"),
    FixedRule("example.com", "/de/", "block"),
    FixedRule("org", "/fr/", "allow"),
)

#: Least share of the labelled urls that a mined combination occurs in with its label, and
#: least share of the urls with the combination that have the label.
SUPPORT, CONFIDENCE = 0.005, 0.7
#: Least number of such urls, so that few labelled urls don't make every combination a rule.
LEAST = 10
#: Verdict of urls that no rule fits.
OTHERWISE = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_verdict(host: Column, path: Column, rules: tuple[FixedRule, ...]) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits, null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in ordered]
    found = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")) for r in ordered]
    return reduce(lambda other, pair: F.when(*pair).otherwise(other), list(zip(fits, found, strict=True))[::-1], F.lit(None))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: host labels, words of hyphenated ones, path parts without digits, query keys."""
    labels = F.split(host, r"\.")
    words = F.flatten(F.transform(F.filter(labels, lambda x: x.contains("-")), lambda x: F.split(x, "-")))
    parts = F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike(r"[0-9]"))
    keys = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)="), 1)
    named = {"host:": F.when(host == "", F.array(F.lit("none"))).otherwise(labels), "word:": words, "path:": parts, "key:": keys}
    return F.array_distinct(F.concat(*(_prefixed(prefix, column) for prefix, column in named.items())))


def _prefixed(prefix: str, tokens: Column) -> Column:
    return F.transform(F.filter(tokens, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Association rules from ``tokens`` and ``verdict``: ``items``, ``verdict``, ``confidence``, ``support``.

    FP-growth counts the combinations that occur in ``support`` of the rows and in
    ``LEAST`` rows at least, among them those that hold a label. A rule with a subset of another's tokens, the same
    verdict and no less confidence makes the other needless.
    """
    items = labelled.select(F.array_append("tokens", F.concat(F.lit("label:"), "verdict")).alias("items"))
    rows = items.count()
    if not rows:
        return labelled.sparkSession.createDataFrame([], "items array<string>, verdict string, confidence double, support double")
    growth = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, LEAST / rows)), minConfidence=confidence)
    model = growth.fit(items)
    rules = model.associationRules.filter(
        F.get("consequent", F.lit(0)).startswith("label:") & ~F.exists("antecedent", lambda x: x.startswith("label:"))
    ).select(
        F.array_sort("antecedent").alias("items"),
        F.substring(F.get("consequent", F.lit(0)), 7, 100).alias("verdict"),
        "confidence",
        "support",
    )
    return minimal(stage(rules, "mined"))


def minimal(rules: DataFrame) -> DataFrame:
    """Rules without those that a rule with fewer of their tokens replaces; found by a shared token."""
    rules = rules.withColumn("id", F.array_join("items", "\x1f"))
    shorter = rules.select(F.get("items", F.lit(0)).alias("token"), *(F.col(c).alias(f"s_{c}") for c in rules.columns))
    needless = (
        rules.select("*", F.explode("items").alias("token"))
        .join(shorter, "token")
        .filter((F.size("s_items") < F.size("items")) & (F.col("s_verdict") == F.col("verdict")))
        .filter((F.size(F.array_except("s_items", "items")) == 0) & (F.col("s_confidence") >= F.col("confidence")))
        .select("id", "verdict")
        .distinct()
    )
    return rules.join(needless, ["id", "verdict"], "left_anti").drop("id")


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Best rule of each row of ``token_sets`` (``key``, ``tokens``): ``key``, ``verdict``, ``confidence``.

    The inverted index lists rules by token; a rule fits a row if as many of its tokens
    are found as it has. The most confident rule wins, then the best supported, then block.
    """
    rules = rules.select(F.xxhash64("items", "verdict").alias("rule"), F.size("items").alias("needed"), "*")
    index = rules.select("rule", "needed", "verdict", "confidence", "support", F.explode("items").alias("token"))
    fitting = (
        token_sets.select("key", F.explode("tokens").alias("token"))
        .join(index, "token")
        .groupBy("key", "rule", "needed", "verdict", "confidence", "support")
        .count()
        .filter(F.col("count") == F.col("needed"))
    )
    best = F.max_by(F.struct("verdict", "confidence"), F.struct("confidence", "support", "verdict"))
    return fitting.groupBy("key").agg(best.alias("best")).select("key", "best.verdict", "best.confidence")


def judge(
    pages: DataFrame,
    rules: tuple[FixedRule, ...] = RULES,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    otherwise: str = OTHERWISE,
) -> DataFrame:
    """Verdict on every row's ``url``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``confidence``.

    ``rule`` is the fixed rule's name or null; ``confidence`` is that of the mined rule
    or null. A null url, or one without ``://``, has an empty host and path and is judged by
    its (few) tokens like others. Repeated rows and null ids come out as they are; other
    columns are not read. Urls with equal tokens are matched once, so a hot host costs
    no more than a rare one.
    """
    url = F.col("url")
    parsed = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    known = fixed_verdict(F.col("host"), F.col("path"), rules)
    parsed = stage(
        parsed.select(
            "page_id", "host", "path", known.alias("fixed"), tokens_of(url, F.col("host"), F.col("path")).alias("tokens")
        ).withColumn("key", F.xxhash64("tokens")),
        "urls",
    )
    labelled = parsed.filter("fixed is not null").select("tokens", F.col("fixed.verdict").alias("verdict"))
    mined = stage(mine(labelled, support, confidence), "rules")
    token_sets = parsed.filter("fixed is null").groupBy("key").agg(F.any_value("tokens").alias("tokens"))
    verdicts = matched(token_sets, mined).withColumnsRenamed({"verdict": "mined", "confidence": "sure"})
    verdicts = stage(verdicts, "verdicts")  # of a scan's own size: small ones are broadcast, a hot key is split
    free = F.col("fixed").isNull()
    return parsed.join(verdicts, "key", "left").select(
        "page_id",
        "host",
        "path",
        F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", "mined", F.lit(otherwise)).alias("verdict"),
        F.when(free, F.col("sure")).alias("confidence"),
    )


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages' urls."""
    return judge(table(spark, sf_dir, "pages"))
