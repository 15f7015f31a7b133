"""URL filters: rules for hosts and paths, and for the rest the ratio of two character models.

The URLs that rules allow and block train two variable-order Markov models over characters. A character's chance given
its context is its count, smoothed by its chance in the shorter context, down to a uniform one. The difference of the
log chances is tabled for each run of 1 to ``ORDER`` characters. A URL's score is the mean difference over its
characters, each taken in the longest run that ends there and that the table has; the threshold lies between the mean scores of the two classes in proportion to their spreads.

DataFrame functions only: runs are counted with partial aggregation, each distinct run is looked up once by a join,
and each distinct URL is scored once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.llm.steps import stored

ORDER = 5
PAD = "^" * (ORDER - 1)
SMOOTHING = 1.0
SYMBOLS = 256.0
BROADCAST_ROWS = 500_000

Rules = list[tuple[str, str]]

#: Verdict and rule (host/path).
RULES: Rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, of equally long ones the first; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for how, name in sorted(reversed(rules), key=lambda r: len(r[1])):
        at, slash, rest = name.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, how).otherwise(verdict)
    return rule, verdict


def _padded(url: Column) -> Column:
    return F.concat(F.lit(PAD), F.coalesce(url, F.lit("")))


def run_counts(urls: DataFrame) -> DataFrame:
    """(run, allowed, blocked): how often each run of 1 to ``ORDER`` characters ends in a URL (url, verdict)."""
    ends = urls.select("verdict", _padded(F.col("url")).alias("text"))
    ends = ends.select("verdict", "text", F.explode(F.sequence(F.lit(ORDER), F.length("text"))).alias("end"))
    runs = F.array(*[F.substring(F.col("text"), F.col("end") - k, F.lit(k + 1)) for k in range(ORDER)])
    runs = ends.select("verdict", F.explode(runs).alias("run"))
    count = lambda verdict: F.sum(F.when(F.col("verdict") == verdict, 1).otherwise(0))
    return runs.groupBy("run").agg(count("allow").alias("allowed"), count("block").alias("blocked"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(run, seen, ratio): log of the two chances of a run's last character given the others."""
    length = F.length("run")
    contexts = counts.select(F.substring(F.col("run"), F.lit(1), length - 1).alias("context"), "allowed", "blocked", length.alias("n"))
    contexts = contexts.groupBy("context", "n").agg(F.sum("allowed").alias("all_allowed"), F.sum("blocked").alias("all_blocked"))
    orders = []
    for n in range(1, ORDER + 1):
        runs = counts.where(length == n).withColumn("context", F.substring("run", 1, n - 1))
        runs = runs.join(contexts.where(F.col("n") == n).drop("n"), "context")
        if n == 1:
            runs = runs.withColumn("p_allowed", F.lit(1 / SYMBOLS)).withColumn("p_blocked", F.lit(1 / SYMBOLS))
        else:
            shorter = orders[-1].select(F.col("run").alias("shorter"), "p_allowed", "p_blocked")
            runs = runs.withColumn("shorter", F.substring("run", 2, n)).join(shorter, "shorter").drop("shorter")
        for how in ("allowed", "blocked"):
            p = (F.col(how) + SMOOTHING * F.col(f"p_{how}")) / (F.col(f"all_{how}") + SMOOTHING)
            runs = runs.withColumn(f"p_{how}", p)
        orders.append(stored(runs.select("run", "allowed", "blocked", "p_allowed", "p_blocked"), "url-chances"))
    done = reduce(DataFrame.union, orders)
    seen = F.col("allowed") + F.col("blocked")
    return done.select("run", seen.alias("seen"), F.log(F.col("p_allowed") / F.col("p_blocked")).alias("ratio"))


def longest_ratios(runs: DataFrame, ratios: DataFrame) -> DataFrame:
    """(run, ratio): for each run the ratio of the longest of its ends that the table has; runs without one are left out."""
    ends = F.explode(F.array(*[F.substring("run", ORDER + 1 - n, n) for n in range(1, ORDER + 1)]))
    found = runs.select("run", ends.alias("end")).join(ratios.select(F.col("run").alias("end"), "ratio"), "end")
    return found.groupBy("run").agg(F.max_by("ratio", F.length("end")).alias("ratio"))


def scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(url, score) of every distinct URL that is neither null nor empty: the mean over its characters of the ratio of
    the longest run that the table has."""
    distinct = urls.select("url").where("length(url) > 0").distinct().withColumn("text", _padded(F.col("url")))
    ends = distinct.select("url", "text", F.explode(F.sequence(F.lit(ORDER), F.length("text"))).alias("end"))
    runs = ends.select("url", F.substring(F.col("text"), F.col("end") - (ORDER - 1), F.lit(ORDER)).alias("run"))
    longest = _checked(stored(longest_ratios(runs.select("run").distinct(), ratios), "url-ratios"))
    found = runs.join(longest, "run", "left")
    return found.groupBy("url").agg(F.avg(F.coalesce("ratio", F.lit(0.0))).alias("score"))


def _checked(rows: DataFrame) -> DataFrame:
    """Broadcast up to ``BROADCAST_ROWS`` short rows; more are joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def judged(pages: DataFrame, rules: Rules = RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule, score and verdict to every page; other columns of these names are replaced.

    A null URL, or one without ``://``, has an empty host and path, and no rule fits an empty path. Null and empty URLs
    score 0. The verdict is the rule's, else allow if the score reaches the threshold. Without URLs that rules allow or
    without such that they block, nothing can be learned and all others are allowed. Repeated rows are judged, and
    learned from, each by itself.
    """
    pages = pages.drop("host", "path", "rule", "score", "verdict")
    ruled = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = ruled.withColumn("rule", rule).withColumn("verdict", verdict)
    known = ruled.where("verdict IS NOT NULL").select(F.col(url).alias("url"), "verdict")
    counts = stored(run_counts(known), "url-runs")
    scored = stored(scores(ruled.select(F.col(url).alias("url")), log_ratios(counts)), "url-scores")
    parts = known.join(scored, "url").groupBy("verdict")
    parts = parts.agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("spread")).collect()
    least = threshold({row.verdict: (row.mean, row.spread) for row in parts})
    scored = scored.select(F.col("url").alias("__url"), F.col("score").alias("__score"))
    found = ruled.join(_checked(scored), F.col(url) == F.col("__url"), "left").drop("__url")
    found = found.withColumn("score", F.coalesce("__score", F.lit(0.0))).drop("__score")
    learned = F.when(F.col("score") >= F.lit(least), "allow").otherwise("block")
    return found.withColumn("verdict", F.coalesce("verdict", learned))


def threshold(classes: dict[str, tuple[float, float]]) -> float:
    """Between the classes' means, as many spreads away from one as from the other."""
    if len(classes) < 2:
        return float("-inf")
    (allowed, a), (blocked, b) = classes["allow"], classes["block"]
    return (allowed * b + blocked * a) / (a + b) if a + b else (allowed + blocked) / 2
