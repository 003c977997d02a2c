"""URL verdicts: listed rules first, then rules that FP-growth mines from labelled URLs.

A URL is a set of tokens (host labels, path segments with digits as 0, names of query fields). Spark's
FP-growth finds token combinations that are frequent among labelled URLs; those that go with the label bad
often enough, and more often than a part of themselves does, become rules. Where labelled URLs have very many
frequent tokens, the same rules are counted level by level instead. An inverted index from token to
rule finds the rules whose tokens a URL has all of.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.llm.store import saved
from fitloom.operators.joins import attach_by_key

MIN_SUPPORT = 0.002
MIN_COUNT = 8
MIN_CONFIDENCE = 0.8
MAX_ANTECEDENT = 3
MAX_TOKENS = 12

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "label:bad"


def host(url: str) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), CAPITALS, SMALL), F.lit(""))


def path(url: str) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def tokens(url: str, host_: str = "host", path_: str = "path") -> Column:
    """Distinct tokens of a URL; none for an empty host and path."""
    labels = F.filter(F.split(host_, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path_, "/"), lambda x: x != "")
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^#]*?\?([^#]*)", 1), "&")
    fields = F.filter(F.transform(query, lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    return F.array_distinct(
        F.concat(
            F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
            F.transform(segments, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0"))),
            F.transform(fields, lambda x: F.concat(F.lit("q:"), x)),
        )
    )


def listed(rules: list[tuple[str, str]], host_: str = "host", path_: str = "path") -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule (verdict, host/path) that fits; null where none does.

    A rule fits its host and all subdomains when the URL's path starts with the rule's path.
    """
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((F.col(host_) == name) | F.col(host_).endswith("." + name)) & F.col(path_).startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _grown(kept: DataFrame, min_support: float, max_antecedent: int) -> DataFrame:
    """(antecedent, support, all) of the frequent sets of ``kept`` (items, bad), by FP-growth."""
    rows = kept.select(F.when(F.col("bad"), F.array_append("items", F.lit(LABEL))).otherwise(F.col("items")).alias("items"))
    sets = FPGrowth(minSupport=min_support).fit(rows).freqItemsets.where(F.size("items") <= max_antecedent + 1)
    sets = saved(sets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    alone = sets.where(~F.array_contains("items", LABEL)).select(F.col("items").alias("antecedent"), F.col("freq").alias("all"))
    with_label = sets.where(F.array_contains("items", LABEL) & (F.size("items") > 1))
    both = with_label.select(F.array_remove("items", LABEL).alias("antecedent"), F.col("freq").alias("support"))
    return both.join(alone, "antecedent")


def _levels(kept: DataFrame, least: int, max_antecedent: int) -> DataFrame:
    """(antecedent, support, all) of sets of ``kept`` (items, bad), one token longer at each level.

    A set that always goes with bad, or is met as often as a part of itself, is not made longer: whatever
    holds it has a part that is as sure, and so is no rule.
    """
    kept = kept.groupBy("items").agg(F.count(F.lit(1)).alias("all"), F.count_if("bad").alias("support"))
    kept = saved(kept.withColumn("id", F.monotonically_increasing_id()), "sets")
    single = kept.select("id", "all", "support", F.explode("items").alias("token"))
    totals = [F.sum("all").alias("all"), F.sum("support").alias("support")]
    counts = saved(single.groupBy(F.array("token").alias("antecedent")).agg(*totals), "level")
    out = counts.where(F.col("support") >= least)
    longer = out.where("support < all").select("antecedent", F.col("all").alias("part"))
    ends = attach_by_key(single.withColumn("antecedent", F.array("token")), longer, ["antecedent"], ["id"])
    ends = saved(ends.select("id", "all", "support", "token", F.col("part").alias("own")), "ends")
    held = ends.select("id", F.array("token").alias("antecedent"), F.col("own").alias("part"))
    for level in range(2, max_antecedent + 1):
        pairs = held.join(ends, "id").where(F.col("token") > F.element_at("antecedent", -1))
        pairs = pairs.select("id", "all", "support", F.array_append("antecedent", F.col("token")).alias("antecedent"), F.least("part", "own").alias("part"))
        counts = pairs.groupBy("antecedent").agg(*totals, F.first("part").alias("part"))
        counts = saved(counts.where((F.col("support") >= least) & (F.col("all") < F.col("part"))), "level")
        out = out.unionByName(counts.drop("part"))
        if level < max_antecedent:
            longer = counts.where("support < all").select("antecedent", F.col("all").alias("part"))
            held = saved(attach_by_key(pairs.select("id", "antecedent"), longer, ["antecedent"], ["id"]), "held")
    return out


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE,
    max_antecedent: int = MAX_ANTECEDENT, max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """(rule_id, antecedent, support, confidence) from ``labelled`` (tokens, bad).

    Supports are counts over whole token sets. Tokens that are too rare among bad URLs are in no rule and left
    out before. FP-growth has all subsets of a long URL that is copied often; where a URL has more than
    ``max_tokens`` tokens left, sets are counted by ``_levels``, which finds the same rules.
    """
    rows = labelled.where("bad is not null").select(F.array_distinct("tokens").alias("tokens"), "bad").where(F.size("tokens") > 0)
    rows = saved(rows.withColumn("id", F.monotonically_increasing_id()), "urls")
    n = rows.count()
    least = max(1, math.ceil(min(1.0, max(min_support, min_count / n)) * n)) if n else 1
    postings = rows.select("id", "bad", F.explode("tokens").alias("token"))
    often = postings.where("bad").groupBy("token").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= least).select("token")
    kept = attach_by_key(postings, often, ["token"], ["id"])
    kept = kept.groupBy("id").agg(F.array_sort(F.collect_list("token")).alias("items"), F.first("bad").alias("bad"))
    kept = saved(kept.select("items", "bad"), "sets")
    size, left = kept.agg(F.max(F.size("items")), F.count(F.lit(1))).first()
    if not size:
        return labelled.sparkSession.createDataFrame([], "rule_id bigint, antecedent array<string>, support bigint, confidence double")
    if size <= max_tokens:
        both = _grown(kept, (least - 0.5) / left, max_antecedent)
    else:
        both = _levels(kept, least, max_antecedent)
    found = both.withColumn("confidence", F.col("support") / F.col("all")).where(F.col("confidence") >= min_confidence)
    found = saved(found.select("antecedent", "support", "confidence"), "rules")
    # a rule adds nothing when a part of it is as sure
    choices = [c for k in range(1, max_antecedent) for c in combinations(range(max_antecedent), k)]
    subset = F.array(*[F.transform(F.array(*[F.lit(i) for i in c]), lambda i: F.get("antecedent", i)) for c in choices])
    parts = F.filter(subset, lambda s: ~F.exists(s, lambda x: x.isNull()) & (F.size(s) < F.size("antecedent")))
    inner = found.select("antecedent", "confidence", F.explode(parts).alias("part"))
    surer = found.select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"))
    weak = inner.join(surer, "part").where("part_confidence >= confidence").select("antecedent").distinct()
    return found.join(weak, "antecedent", "left_anti").select(F.xxhash64("antecedent").alias("rule_id"), "antecedent", "support", "confidence")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, antecedent, confidence) of the surest rule that each of the distinct ``urls`` (url, tokens) fulfils.

    The inverted index is joined on the token; of equally sure rules the one of greatest support, then the
    first by its tokens, is named.
    """
    index = saved(rules.select("rule_id", "confidence", "support", "antecedent", F.size("antecedent").alias("n"), F.explode("antecedent").alias("token")), "index")
    postings = urls.select("url", F.explode("tokens").alias("token"))
    hits = postings.join(index.select("token", "rule_id", "n"), "token").groupBy("url", "rule_id").agg(F.count(F.lit(1)).alias("has"), F.first("n").alias("n"))
    whole = hits.where("has = n").select("url", "rule_id").join(rules, "rule_id")
    best = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "antecedent"))
    return whole.groupBy("url").agg(best.alias("m")).select("url", F.col("m.antecedent").alias("antecedent"), (-F.col("m.c")).alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], page_id: str = "page_id", url: str = "url", **mining) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern, confidence) per row of ``pages``.

    ``labels`` (id, bad) covers some pages. A listed rule decides; else a mined rule (``pattern``) blocks; else
    the URL is allowed. A null URL, or one without ``://``, has an empty host and path and is allowed. Repeated
    rows get the same; a label without a page, or a null one, is not used.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).withColumns({"host": host("url"), "path": path("url")})
    bad = labels.toDF("page_id", "bad").where("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    mined = saved(mine(rows.join(bad, "page_id").select(tokens("url").alias("tokens"), "bad"), **mining), "mined")
    rule, verdict = listed(rules)
    judged = rows.withColumns({"rule": rule, "verdict": verdict})
    urls = judged.where("verdict is null and url is not null").select("url", tokens("url").alias("tokens")).dropDuplicates(["url"])
    found = saved(matches(urls, mined), "matches")
    out = judged.join(found, "url", "left")
    pattern = F.when(F.col("verdict").isNull(), F.array_join("antecedent", " "))
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(pattern.isNotNull(), "block").otherwise("allow")).alias("verdict"),
        pattern.alias("pattern"), F.when(pattern.isNotNull(), F.col("confidence")).alias("confidence"),
    )
