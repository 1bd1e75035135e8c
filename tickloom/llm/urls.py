"""URL filter by the ratio of two character language models.

Two smoothed variable-order Markov models, one of accepted and one of rejected URLs, judge a URL by the difference of its
log-likelihoods per character. Smoothing is recursive: a context of k characters gives
P_k = (n(gram) + m P_{k-1}) / (n(context) + m), and a context that was never seen leaves P_{k-1} as it is. The difference of
logarithms then telescopes into one weight for every substring, so a URL's score is the sum of the weights of its
substrings: one explode, one join with the table of weights, one sum.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import ascii_lower, written

BEGIN, FINISH = "\x02", "\x03"
#: Fixed values: (host, path, verdict) of the rules.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: Longest context, prior weight of the shorter context, and the most substrings for which the weights are broadcast.
ORDER, PRIOR, BROADCAST_GRAMS = 3, 2.0, 1_000_000
HOLD_OUT = 4
#: The SQL counterpart draws so many URLs of each verdict where there are more; the operator learns from all of them.
LEARN_FROM = 20_000


def host_of(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, in lower case; empty without `://`."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for domain, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        rule, verdict = F.when(fits, domain + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _substrings(text: Column, longest: int) -> Column:
    """All substrings of up to `longest` characters, with repeats."""
    of = lambda k: F.transform(F.sequence(F.lit(1), F.length(text) - k + 1), lambda i: F.substring(text, i, F.lit(k)))
    return F.concat(*(F.when(F.length(text) >= k, of(k)).otherwise(F.array().cast("array<string>")) for k in range(1, longest + 1)))


def _digits(url: str, at: int) -> Column:
    """A number below 2^32 from eight hex digits of the URL's hash."""
    return F.conv(F.substring(F.md5(F.coalesce(url, F.lit(""))), at, 8), 16, 10).cast("long")


def _marked(url: str) -> Column:
    return F.concat(F.lit(BEGIN), F.coalesce(url, F.lit("")), F.lit(FINISH))


@dataclass
class UrlModel:
    """weights: (gram, weight), positive for accepted; unseen: weight of any character; threshold: least score to accept."""

    weights: DataFrame
    unseen: float
    threshold: float
    few: bool


def _scored(urls: DataFrame, weights: DataFrame, unseen: float, few: bool, order: int) -> DataFrame:
    """Adds `log_ratio`; `urls` has `url` and a `row` that tells its rows apart. A row's substrings stay in its task."""
    grams = urls.select("row", F.explode(_substrings(_marked("url"), order + 1)).alias("gram"))
    per_row = grams.join(F.broadcast(weights) if few else weights, "gram").groupBy("row").agg(F.sum("weight").alias("total"))
    characters = F.length(F.coalesce("url", F.lit(""))) + 1
    ratio = (F.coalesce("total", F.lit(0.0)) + F.lit(unseen) * characters) / characters
    return urls.join(per_row, "row", "left").withColumn("log_ratio", ratio).drop("total")


def fit(labelled: DataFrame, order: int = ORDER, prior: float = PRIOR, learn_from: int | None = None) -> UrlModel | None:
    """Models and threshold from (url, verdict); None if either verdict has no URL.

    Counts are of all labelled URLs but a quarter, which is held out for the threshold: it lies between the mean scores of
    the two verdicts, as many standard deviations from either. A caller may bound what is learned from by `learn_from`
    URLs of each verdict (in expectation, spread evenly).
    """
    counts = {r.verdict: r.n for r in labelled.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    if not counts.get("allow") or not counts.get("block"):
        return None
    if learn_from is not None:
        share = F.when(F.col("verdict") == "allow", learn_from / counts["allow"]).otherwise(learn_from / counts["block"])
        labelled = labelled.where(_digits("url", 1) / float(1 << 32) < share)
    chosen = labelled.select("url", "verdict", (_digits("url", 9) % HOLD_OUT == 0).alias("held_out"))
    seen = chosen.where(~F.col("held_out")).select("verdict", F.explode(_substrings(_marked("url"), order + 1)).alias("gram"))
    n = lambda verdict: F.count(F.when(F.col("verdict") == verdict, 1)).cast("double")
    grams = written(seen.groupBy("gram").agg(n("allow").alias("n_a"), n("block").alias("n_r")), "url-grams")
    singles = grams.where((F.length("gram") == 1) & (F.col("gram") != BEGIN))
    total = singles.agg(F.sum("n_a").alias("a"), F.sum("n_r").alias("r"), F.count("*").alias("kinds")).first()
    size, half = (total.kinds or 0) + 1, 0.5
    floor = {c: half / ((total[c] or 0) + half * size) for c in "ar"}
    first = [((F.col(f"n_{c}") + half) / F.lit((total[c] or 0) + half * size)).alias(f"p_{c}") for c in "ar"]
    level = written(singles.select("gram", *first), "url-level")
    unseen = math.log(floor["a"] / floor["r"])
    seen_context = F.when(F.col("gram").endswith(FINISH), 0.0).otherwise(F.log((F.col("n_r") + prior) / (F.col("n_a") + prior)))
    contexts = grams.where(F.length("gram") <= order).select("gram", seen_context.alias("weight"))
    parts = [contexts, level.select("gram", (F.log(F.col("p_a") / F.col("p_r")) - unseen).alias("weight"))]
    for k in range(2, order + 2):
        prefix = grams.select(F.col("gram").alias("context"), F.col("n_a").alias("c_a"), F.col("n_r").alias("c_r"))
        shorter = level.select(F.col("gram").alias("suffix"), F.col("p_a").alias("s_a"), F.col("p_r").alias("s_r"))
        here = grams.where(F.length("gram") == k).withColumns({"context": F.substring("gram", 1, k - 1), "suffix": F.substring("gram", 2, k - 1)})
        here = here.join(prefix, "context").join(shorter, "suffix")
        p = [((F.col(f"n_{c}") + prior * F.col(f"s_{c}")) / (F.col(f"c_{c}") + prior)).alias(f"p_{c}") for c in "ar"]
        gained = F.log(F.col("p_a") / F.col("p_r")) - F.log(F.col("s_a") / F.col("s_r")) - F.log((F.col("c_r") + prior) / (F.col("c_a") + prior))
        level = written(here.select("gram", *p, "s_a", "s_r", "c_a", "c_r"), "url-level")
        parts.append(level.select("gram", gained.alias("weight")))
    weights = written(reduce(DataFrame.unionByName, parts).groupBy("gram").agg(F.sum("weight").alias("weight")), "url-weights")
    few = weights.count() <= BROADCAST_GRAMS
    held = _scored(chosen.where("held_out").withColumn("row", F.monotonically_increasing_id()), weights, unseen, few, order)
    stats = {r.verdict: r for r in held.groupBy("verdict").agg(F.avg("log_ratio").alias("mean"), F.coalesce(F.stddev_pop("log_ratio"), F.lit(0.0)).alias("sd")).collect()}
    threshold = 0.0
    if len(stats) == 2:
        a, r = stats["allow"], stats["block"]
        threshold = (a["mean"] * r.sd + r["mean"] * a.sd) / (a.sd + r.sd) if a.sd + r.sd > 0 else (a["mean"] + r["mean"]) / 2
    return UrlModel(weights, unseen, float(threshold), few)


def filter_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: list[tuple[str, str, str]] = RULES, order: int = ORDER, prior: float = PRIOR, learn_from: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, log_ratio) for every row of `pages`.

    URLs that a rule decides are what the models learn from; the models decide the others. A null URL, or one without
    `://`, has an empty host and path, fits no rule and is judged as text. If the rules accept or reject nothing there is
    nothing to compare with: the others are allowed, with ratio 0. Repeated rows are each judged, an empty table gives an
    empty one, further columns are ignored.
    """
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = written(rows.withColumns({"rule": rule, "verdict": verdict}), "urls")
    model = fit(rows.where(F.col("verdict").isNotNull()).select("url", "verdict"), order, prior, learn_from)
    if model is None:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("log_ratio"))
    judged = _scored(rows, model.weights, model.unseen, model.few, order)
    says = F.when(F.col("log_ratio") >= model.threshold, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", says).alias("verdict"), "log_ratio")
