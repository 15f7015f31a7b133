"""Mixing sources: shares raised to a power, the power found by bisection, weights realised as block permutations.

The weight of a source is its share of all tokens raised to a power and normalised: 1 keeps the shares, 0 gives every
source the same, more than 1 favours large sources. Bisection finds the smallest power whose weights repeat no source
more than ``max_repeats`` times within the budget, or the power whose weights have a wanted entropy. A source then gives whole epochs and a part of
one. Each epoch is a permutation of blocks and of the rows within them, both by hash, so that no source is sorted or
summed in one piece: sums over rows stay within a block, sums over blocks have one row per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterlens.llm.steps import stored

STEPS = 60
STEEPEST = 1024.0  # power beyond which the weights are those of the largest sources alone
ENTROPY_REPEATS = 16.0  # repeats that a wanted entropy may need
BLOCK_ROWS = 4096
MAX_SOURCES = 100_000

Totals = list[tuple[str | None, int]]


def tempered(totals: Totals, power: float) -> list[float]:
    """Weight of each source."""
    most = max((tokens for _, tokens in totals), default=1)
    raised = [math.exp(power * math.log(tokens / most)) for _, tokens in totals]
    return [x / sum(raised) for x in raised]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def most_repeats(totals: Totals, weights: list[float], budget: int) -> float:
    return max((budget * w / tokens for w, (_, tokens) in zip(weights, totals)), default=0.0)


def power_for(totals: Totals, budget: int, max_repeats: float | None = None, target_entropy: float | None = None) -> float:
    """The power by bisection; repeats and entropy both fall as it grows.

    For a limit of repeats the power is between 0 and 1: 0 if even equal weights meet it, 1 if only the shares do. A
    budget that no weights can fill within the limit is an error. For an entropy it is between 0 and ``STEEPEST``; an
    entropy that no power gives is an error, as is one whose weights need more than ``max_repeats`` repeats, or
    ``ENTROPY_REPEATS`` if no limit is given.
    """
    if target_entropy is None:
        if budget > max_repeats * sum(tokens for _, tokens in totals):
            raise ValueError("the budget needs more repeats than allowed")
        return _least_power(lambda power: most_repeats(totals, tempered(totals, power), budget) <= max_repeats, 1.0)
    power = _least_power(lambda power: entropy(tempered(totals, power)) <= target_entropy, STEEPEST)
    weights = tempered(totals, power)
    if abs(entropy(weights) - target_entropy) > 1e-6:
        least, most = (entropy(tempered(totals, end)) for end in (STEEPEST, 0.0))
        raise ValueError(f"no power gives the entropy {target_entropy}: it can be {least:.6f} to {most:.6f}")
    limit = ENTROPY_REPEATS if max_repeats is None else max_repeats
    if most_repeats(totals, weights, budget) > limit:
        raise ValueError(f"the entropy {target_entropy} needs more than {limit} repeats of a source")
    return power


def _least_power(fits: Callable[[float], bool], high: float) -> float:
    """The least power up to ``high`` that fits, and ``high`` if none does; what fits, fits at larger powers too."""
    low = 0.0
    if fits(low):
        return low
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(id, source, digest, tokens) of documents with tokens: words between ASCII blanks."""
    tokens = F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    name = F.concat_ws("|", F.col(key).cast("string"), F.md5(F.col(text)))
    rows = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), F.md5(name).alias("digest"), tokens.alias("tokens"))
    return rows.where("tokens > 0")


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mixture(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget: int | None = None,
    max_repeats: float | None = None,
    target_entropy: float | None = None,
    seed: int = 0,
) -> DataFrame:
    """(id, source, epoch, block, begins, tokens, target): what to train on, one row per use of a document.

    ``target`` is the source's part of the budget (all tokens of the documents, if none is given), rounded down.
    Epochs before the last are whole; of the last the rows that end within the target are taken, in the order of the
    permutation. ``begins`` counts the source's tokens before the row, over all epochs: to interleave the sources,
    order by begins / target. Give ``max_repeats``, or ``target_entropy`` and, if it may need more or fewer repeats than
    ``ENTROPY_REPEATS``, ``max_repeats`` as their limit; a target that cannot be met is an error.

    A null source is a source of its own. Null and empty texts have no tokens and are left out. Repeated rows are
    uses of their own; equal rows are interchangeable. An empty table gives an empty result. Up to ``MAX_SOURCES``
    sources are weighed on the driver; more are an error.
    """
    if max_repeats is None and target_entropy is None:
        raise ValueError("give max_repeats or target_entropy")
    spark = docs.sparkSession
    rows = stored(sized(docs, key, text, source), "sized")
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    found = totals.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found = sorted(found, key=lambda row: (row.source is None, row.source or ""))
    sums = [(row.source, row.tokens) for row in found]
    budget = sum(tokens for _, tokens in sums) if budget is None else budget
    weights = tempered(sums, power_for(sums, budget, max_repeats, target_entropy)) if sums else []
    plan = [
        (row.source, row.tokens, -(-row.rows // BLOCK_ROWS), math.floor(budget * weight))
        for row, weight in zip(found, weights)
    ]
    schema = f"source {rows.schema['source'].dataType.simpleString()}, total long, blocks long, target long"
    plan = F.broadcast(spark.createDataFrame(plan, schema).withColumnRenamed("source", "planned"))
    uses = rows.join(plan, F.col("source").eqNullSafe(F.col("planned"))).drop("planned")
    last = F.ceil(F.col("target") / F.col("total")) - 1
    uses = uses.where("target > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    uses = uses.withColumn("block", F.pmod(_number(F.col("digest")), F.col("blocks")))
    uses = uses.withColumn("place", F.md5(F.concat_ws("|", F.lit(seed), "epoch", "digest")))
    return _placed(uses, seed).where("begins + tokens <= target")


def _placed(uses: DataFrame, seed: int) -> DataFrame:
    """Add the number of the source's tokens before each use."""
    blocks = uses.groupBy("source", "epoch", "block").agg(F.sum("tokens").alias("held"))
    order = F.md5(F.concat_ws("|", F.lit(seed), "epoch", "source", "block"))
    over_blocks = Window.partitionBy("source", "epoch").orderBy("order", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("order", order).withColumn("before", F.coalesce(F.sum("held").over(over_blocks), F.lit(0)))
    blocks = blocks.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("block").alias("b"), "before")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("block") == F.col("b"))
    in_block = Window.partitionBy("source", "epoch", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    uses = uses.withColumn("within", F.coalesce(F.sum("tokens").over(in_block), F.lit(0))).join(blocks, same)
    begins = F.col("epoch") * F.col("total") + F.col("before") + F.col("within")
    return uses.select("id", "source", F.col("epoch").cast("int").alias("epoch"), "block", begins.alias("begins"), "tokens", "target")
