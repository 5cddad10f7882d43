"""URL filters: given host and path rules, else association rules mined from labelled pages.

A URL is a basket of tokens. FP-growth finds token combinations that go with the block
label; those with enough support and confidence are rules. They are matched through an
inverted index: every rule is listed under one of its tokens, so a URL meets only rules
that share a token with it, and a combination holds if none of its tokens is missing.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from oddsline.llm.common import lower_ascii, written

BLOCK, ALLOW = "block", "allow"
#: The item that stands for the label; URL tokens have a letter and a colon in front.
LABEL = "=block"
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.6
#: Without a given support, MIN_SUPPORT is a share of the bad pages, and at least so many.
MIN_PAGES = 3
#: The lower bound of a rule's confidence, so many standard errors down, has to be so many
#: times the share of bad pages: of the many combinations some few are bad by chance.
ERRORS, MIN_LIFT = 3, 1.5


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null and without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(rules: list[tuple[str, str]], host_: Column, path_: Column) -> Column:
    """The longest given rule that fits, as a struct (rule, verdict); null if none does.

    ``rules`` are (rule, verdict); a rule is a host, which includes its subdomains, and
    the start of a path. Of equally long ones the first given wins.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in reversed(sorted(rules, key=lambda r: -len(r[0]))):
        domain, slash, rest = rule.partition("/")
        domain = domain.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
        fits = (((host_ == domain) | F.endswith(host_, F.lit(f".{domain}")))
                & F.startswith(path_, F.lit(slash + rest)))
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL: host labels, path segments with digits masked, query
    keys, and whether it has a fragment."""
    labels = F.transform(F.filter(F.split(host(url), r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    masked = F.transform(F.filter(F.split(path(url), "/"), lambda x: x != ""),
                         lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0")))
    keys = F.transform(F.regexp_extract_all(after_scheme(url), F.lit(r"[?&]([^=&#]+)"), F.lit(1)),
                       lambda x: F.concat(F.lit("q:"), x))
    fragment = F.when(F.contains(after_scheme(url), F.lit("#")), F.array(F.lit("f:"))).otherwise(
        F.array().cast("array<string>"))
    return F.coalesce(F.array_distinct(F.concat(labels, masked, keys, fragment)), F.array().cast("array<string>"))


def document_number(url: Column) -> Column:
    """The number that ends the path of a URL, before a file extension; null if there is none."""
    found = F.regexp_extract(path(url), r"/([0-9]+)(?:\.[A-Za-z0-9]+)?/?$", 1)
    return found.try_cast("long")


def lower_bound(confidence: Column, n: Column) -> Column:
    """The Wilson bound below a share of ``n`` pages."""
    z = float(ERRORS * ERRORS)
    spread = F.sqrt(confidence * (1 - confidence) / n + z / (4 * n * n))
    return (confidence + z / (2 * n) - ERRORS * spread) / (1 + z / n)


def mined(pages: DataFrame, labels: DataFrame, min_support: float | None = None,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (antecedent, confidence, support) for blocking, from all labelled pages.

    A page is labelled through the document whose number ends the path of its URL; it is
    bad if its quality is 0 or it is toxic. Pages without number or label, and labels
    without page, teach nothing. ``min_support`` is a share of all labelled pages.
    """
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    judged = labels.select("doc_id", bad.alias("_bad")).groupBy("doc_id").agg(F.max("_bad").alias("_bad"))
    rows = (pages.select(document_number(F.col("url")).alias("_number"), tokens(F.col("url")).alias("_tokens"))
            .join(judged, F.col("_number") == F.col("doc_id")))
    baskets = written(rows.select(F.when(F.col("_bad"), F.concat("_tokens", F.array(F.lit(LABEL))))
                                  .otherwise(F.col("_tokens")).alias("items")), "baskets")
    n, n_bad = baskets.agg(F.count("*"), F.count(F.when(F.array_contains("items", LABEL), 1))).first()
    if min_support is None:  # half a page less, as FPGrowth rounds the product up
        min_support = min(1.0, (max(MIN_PAGES, math.ceil(MIN_SUPPORT * n_bad)) - 0.5) / max(n, 1))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    held = F.round(F.col("support") * n / F.col("confidence"))  # pages that hold the combination
    return (model.associationRules.filter(F.col("consequent") == F.array(F.lit(LABEL)))
            .filter(lower_bound(F.col("confidence"), held) >= MIN_LIFT * n_bad / max(n, 1))
            .select(F.sort_array("antecedent").alias("antecedent"), "confidence", "support"))


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, combination, confidence) of URLs that hold a mined rule: the most confident."""
    index = written(rules.select(F.col("antecedent")[0].alias("_token"), "antecedent", "confidence", "support"), "index")
    urls = pages.select("url").filter("url IS NOT NULL").distinct().withColumn("_tokens", tokens(F.col("url")))
    met = (urls.select("url", "_tokens", F.explode("_tokens").alias("_token")).join(index, "_token")
           .filter(F.size(F.array_except("antecedent", "_tokens")) == 0))
    best = F.max(F.struct("confidence", "support", F.array_join("antecedent", " ").alias("combination")))
    return met.groupBy("url").agg(best.alias("_best")).select("url", "_best.combination", "_best.confidence")


def filtered(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, combination, confidence.

    A given rule decides alone; else a URL that holds a mined combination is blocked and
    any other allowed. A null URL or one without ``://`` has no host, path or tokens and is
    allowed. Repeated rows get a row each; extra columns are ignored; without labels
    nothing is mined.
    """
    found = matched(pages, mined(pages, labels))
    rows = (pages.select("page_id", "url").withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
            .withColumn("_rule", matching_rule(rules, F.col("host"), F.col("path"))))
    verdict = F.coalesce("_rule.verdict", F.when(F.col("combination").isNotNull(), BLOCK).otherwise(ALLOW))
    return rows.join(found, "url", "left").select(
        "page_id", "host", "path", "_rule.rule", verdict.alias("verdict"), "combination", "confidence")
