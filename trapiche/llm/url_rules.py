"""URL verdicts: written rules first, then association rules mined from what they label."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.llm.common import fresh
from trapiche.sinks.writers import store

ALLOW, BLOCK = "allow", "block"
LEAST_SUPPORT = 0.01
LEAST_CONFIDENCE = 0.9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """A rule from text such as `example.com/en/`."""
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path; both empty for a null url or one without `://`."""
    rest = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, rest, 1), _UPPER, _LOWER)
    return host, F.regexp_extract(whole, rest, 2)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as struct(rule, verdict), the first of ties; null for none."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    # From short to long: a later rule that fits overrides.
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(
            path, F.lit(r.path)
        )
        this = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, this).otherwise(found)
    return found


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct labels of the host and words of the path, each marked by where it stands."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    words = F.transform(F.split(F.lower(path), "[^\\p{L}\\p{N}]+"), lambda x: F.concat(F.lit("path:"), x))
    return F.array_distinct(
        F.filter(F.concat(labels, words), lambda x: ~x.isin("host:", "path:"))
    )


def mine_rules(
    labelled: DataFrame,
    least_support: float = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """`labelled(tokens, verdict)` -> `(tokens, verdict, confidence, support)`.

    FP-growth counts token combinations together with their verdict; kept are combinations with
    enough support and confidence, and of those with one verdict only the ones of which no part
    is as sure already.
    """
    verdict = F.concat(F.lit("verdict:"), F.col("verdict"))
    baskets = labelled.select(F.concat("tokens", F.array(verdict)).alias("items"))
    model = FPGrowth(
        itemsCol="items", minSupport=least_support, minConfidence=least_confidence
    ).fit(baskets)
    mined = model.associationRules.where(
        F.startswith(F.col("consequent")[0], F.lit("verdict:"))
        & ~F.exists("antecedent", lambda x: F.startswith(x, F.lit("verdict:")))
    ).select(
        F.array_sort("antecedent").alias("tokens"),
        F.substring_index(F.col("consequent")[0], ":", -1).alias("verdict"),
        "confidence",
        "support",
    )
    mined = store(mined)
    # A part of a combination shares a token with it, so the test is an equi-join on tokens.
    parts = mined.select(
        F.explode("tokens").alias("token"),
        F.col("tokens").alias("part"),
        F.col("verdict").alias("part_verdict"),
        F.col("confidence").alias("part_confidence"),
    )
    wholes = mined.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
    implied = (
        wholes.join(parts, "token")
        .where(
            (F.col("part_verdict") == F.col("verdict"))
            & (F.size("part") < F.size("tokens"))
            & (F.size(F.array_except("part", "tokens")) == 0)
            & (F.col("part_confidence") >= F.col("confidence"))
        )
        .select("tokens", "verdict")
        .distinct()
    )
    return mined.join(implied, ["tokens", "verdict"], "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`urls(host, path, tokens)` with the surest mined rule: `(host, path, mined)`.

    The inverted index holds each rule under one token, the one that fewest rules have, and a
    URL looks up its own tokens; the whole combination is verified on what that finds. Ties go
    to the longer combination, then to block.
    """
    tokens = rules.select("*", F.explode("tokens").alias("token"))
    use = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("rules"))
    index = (
        tokens.join(use, "token")
        .groupBy("tokens", "verdict", "confidence")
        .agg(F.min(F.struct("rules", "token")).alias("rarest"))
        .select(
            F.col("rarest.token").alias("token"),
            F.col("tokens").alias("needed"),
            "verdict",
            "confidence",
        )
    )
    sure = F.struct("confidence", F.size("needed").alias("length"), "verdict")
    looked_up = urls.select("host", "path", "tokens", F.explode("tokens").alias("token"))
    return (
        looked_up.join(store(index), "token")
        .where(F.size(F.array_except("needed", "tokens")) == 0)
        .groupBy("host", "path")
        .agg(F.max(sure).alias("mined"))
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    url_col: str = "url",
    least_support: float = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """Every row with `host`, `path`, `rule` and `verdict` beside its own columns.

    Names that `pages` has already get an underscore. A written rule decides where one fits;
    its text is in `rule`. Other URLs get the verdict of the surest mined rule, and are allowed
    without one. Null URLs and URLs without `://` have an empty host and path, fit no rule and
    are allowed. Nothing labelled, or an empty table, gives no mined rules. Each distinct host
    and path is looked up once; the rows meet its verdict in a join that adaptive execution
    splits where one URL is hot.
    """
    host, path = url_parts(F.col(f"`{url_col}`"))
    names = fresh(pages, "host", "path", "rule", "verdict", "written")
    marked = pages.withColumn(names[0], host).withColumn(names[1], path)
    marked = marked.withColumn(names[4], best_rule(F.col(names[0]), F.col(names[1]), rules))
    seen = marked.select(
        F.col(names[0]).alias("host"), F.col(names[1]).alias("path"), F.col(names[4]).alias("written")
    )
    urls = seen.select(
        "host", "path", url_tokens(F.col("host"), F.col("path")).alias("tokens"),
        F.col("written.verdict").alias("verdict"),
    )
    labelled = urls.where("verdict IS NOT NULL").select("tokens", "verdict")
    mined = mine_rules(labelled, least_support, least_confidence)
    open_urls = urls.where("verdict IS NULL").drop("verdict").distinct()
    found = store(match_rules(open_urls, mined))
    joined = marked.alias("rows").join(
        found.alias("found"),
        (F.col(f"rows.{names[0]}") == F.col("found.host"))
        & (F.col(f"rows.{names[1]}") == F.col("found.path")),
        "left",
    )
    written = F.col(f"rows.{names[4]}")
    return joined.select(
        *[F.col(f"rows.`{c}`") for c in pages.columns],
        F.col(f"rows.{names[0]}").alias(names[0]),
        F.col(f"rows.{names[1]}").alias(names[1]),
        written["rule"].alias(names[2]),
        F.coalesce(written["verdict"], F.col("found.mined.verdict"), F.lit(ALLOW)).alias(names[3]),
    )
