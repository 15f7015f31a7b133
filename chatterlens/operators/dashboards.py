"""Questions asked of stored results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterlens.functions.stopwords import ENGLISH
from chatterlens.functions.text import clean_text, each, words_of

# How a missing label is counted.
NO_LABEL = "unlabelled"

# Event times between which empty buckets are filled in.
PLAUSIBLE = ("2000-01-01", "2100-01-01")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def distribution(df: DataFrame, column: str = "sentiment") -> DataFrame:
    """Rows per value of ``column`` and their share of all rows."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def volume_by(df: DataFrame, column: str = "source") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def _bucketed(df: DataFrame, width: str, time: str) -> DataFrame:
    return df.filter(F.col(time).isNotNull()).withColumn("bucket", F.window(time, width)["start"])


def sentiment_over_time(
    df: DataFrame,
    width: str = "5 minutes",
    labels: Sequence[str] = (),
    fill: bool = False,
    time: str = "event_time",
    plausible: tuple[str, str] = PLAUSIBLE,
) -> DataFrame:
    """Messages per time bucket and label.

    With ``fill`` the buckets between the first and the last of ``plausible`` times that hold no message appear too,
    and each of these buckets has a number, if only zero, for each of ``labels``, besides the numbers of the other
    labels that it holds. Times are user text: buckets outside ``plausible`` are given as they were counted, and
    nothing is filled in up to them. Rows without a time are in no bucket, rows without a label count as ``NO_LABEL``.
    """
    label = F.coalesce("sentiment", F.lit(NO_LABEL)).alias("sentiment")
    counts = _bucketed(df, width, time).groupBy("bucket", label).agg(F.count("*").alias("n"))
    if not fill:
        return counts
    if not labels:
        raise ValueError("filling empty buckets needs the labels")
    # One row per bucket with all of its counts; the gap up to the next one is filled day by day.
    held = counts.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("sentiment", "n"))).alias("held"))
    inside = F.col("bucket").between(*[F.lit(end).cast("timestamp") for end in plausible])
    held = held.withColumn("inside", inside)
    following = F.lead("bucket").over(Window.partitionBy("inside").orderBy("bucket"))
    held = held.withColumn("next", F.when(F.col("inside"), following))
    step, day = F.expr(f"interval {width}"), F.expr("interval 1 day")
    begin = F.col("bucket") + step
    days = F.when(begin < F.col("next"), F.sequence(begin, F.col("next") - F.expr("interval 1 microsecond"), day))
    gaps = held.select("next", F.explode(days).alias("day"))
    until = F.least(F.col("day") + day, F.col("next")) - F.expr("interval 1 microsecond")
    empty = gaps.select(F.explode(F.sequence("day", until, step)).alias("bucket"))
    wanted = F.array(*[F.lit(label) for label in labels])
    none = F.lit(None).cast(held.schema["held"].dataType)
    rows = held.select("bucket", "held", "inside").unionByName(empty.select("bucket", none.alias("held"), F.lit(True).alias("inside")))
    own = F.coalesce(F.map_keys("held"), F.array().cast("array<string>"))
    rows = rows.withColumn("sentiment", F.explode(F.when(F.col("inside"), F.array_union(wanted, own)).otherwise(own)))
    return rows.select("bucket", "sentiment", F.coalesce(F.col("held")[F.col("sentiment")], F.lit(0)).alias("n"))


def sentiment_columns(
    df: DataFrame, labels: Sequence[str], width: str = "5 minutes", time: str = "event_time", other: str | None = None
) -> DataFrame:
    """The same counts with one column per label, and one named ``other`` for all further labels and for none."""
    label, names = F.col("sentiment"), list(labels)
    if other is not None:
        label, names = F.when(label.isin(names), label).otherwise(other), [*names, other]
    labelled = _bucketed(df, width, time).withColumn("sentiment", label)
    counted = labelled.groupBy("bucket").pivot("sentiment", names).agg(F.count(F.lit(1)))
    return counted.fillna(0, names)


def since(df: DataFrame, as_of: Column, width: str = "1 hour", time: str = "event_time") -> DataFrame:
    """Rows of the last ``width`` before ``as_of``. Stored results also skip the folders of older days."""
    start = as_of - F.expr(f"interval {width}")
    recent = df.filter(F.col(time) >= start)
    if "event_date" in df.columns:
        recent = recent.filter(F.col("event_date") >= F.to_date(start))
    return recent


def newest(df: DataFrame, time: str = "event_time") -> Column:
    """Time of the newest row, to be used in other columns. It reads the times of all rows."""
    return df.agg(F.max(time)).scalar()


def last_hour(df: DataFrame, as_of: Column | None = None, time: str = "event_time") -> DataFrame:
    """Rows of the hour before ``as_of``, which is now if not given. Stored results skip the folders of older days."""
    return since(df, F.current_timestamp() if as_of is None else as_of, "1 hour", time)


def latest_rows(df: DataFrame, time: str = "event_time", tie: str = "id", n: int = 5) -> DataFrame:
    """The newest rows; rows without a time come last."""
    return df.orderBy(F.desc_nulls_last(time), F.desc(tie)).limit(n)


def preview(df: DataFrame, columns: Sequence[str], key: str, n: int = 5, width: int = 50) -> DataFrame:
    """The first rows by ``key`` with long text cut for reading."""
    short = [F.substring(c, 1, width).alias(c) for c in columns]
    return df.select(key, *short).orderBy(key).limit(n)


def top_values(df: DataFrame, column: str = "user", n: int = 10) -> DataFrame:
    """Most frequent values; ties are ordered by value. Rows without a value are not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(n)


def top_texts(df: DataFrame, column: str = "text", n: int = 50) -> DataFrame:
    """Most frequent whole texts; ties are ordered by digest.

    Only digests are counted and shuffled. The few winners then pick up their text in a second scan, in which
    each task sends on at most one copy per winner: a set of equal texts needs no sort of the copies.
    """
    keyed = df.filter(F.col(column).isNotNull()).select(F.md5(column).alias("digest"), column)
    counts = keyed.groupBy("digest").agg(F.count("*").alias("n"))
    winners = counts.orderBy(F.desc("n"), F.asc("digest")).limit(n)
    texts = keyed.join(winners, "digest")
    return texts.groupBy("digest", "n").agg(F.collect_set(column)[0].alias(column)).select(column, "n")


def _topical_words(df: DataFrame, column: str, stop_words: Sequence[str], *kept: Column) -> DataFrame:
    words = df.select(*kept, each(words_of(clean_text(F.col(column)))).alias("word"))
    return words.filter(F.col("word").isNotNull() & (F.col("word") != "") & ~F.col("word").isin(*stop_words))


def rising_words(
    df: DataFrame,
    as_of: Column,
    width: str = "1 hour",
    before: str = "7 days",
    n: int = 50,
    least: int = 5,
    column: str = "text",
    time: str = "event_time",
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """(word, recent, earlier, score) of the words whose rate has risen most in the last ``width``.

    The score is the log-likelihood ratio of the word's rates in the last ``width`` and in the time ``before`` that;
    words that are no more frequent than before, or are said fewer than ``least`` times, are left out. Rounded to six
    digits; equal scores are ordered by word. A word that was not said before has the highest rise its count allows.
    """
    start = as_of - F.expr(f"interval {width}")
    inside = df.filter(F.col(time).between(start - F.expr(f"interval {before}"), as_of))
    counts = _topical_words(inside, column, stop_words, (F.col(time) >= start).alias("new")).groupBy("word")
    counts = counts.agg(F.count_if("new").alias("recent"), F.count_if(~F.col("new")).alias("earlier"))
    recent, earlier = F.col("recent"), F.col("earlier")
    all_recent, all_earlier = (counts.agg(F.sum(name)).scalar() for name in ("recent", "earlier"))
    share = (recent + earlier) / (all_recent + all_earlier)

    def part(seen: Column, of: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (of * share))).otherwise(0.0)

    score = F.round(2 * (part(recent, all_recent) + part(earlier, all_earlier)), 6)
    risen = counts.filter(recent >= least).filter(recent * all_earlier > earlier * all_recent)
    return risen.withColumn("score", score).orderBy(F.desc("score"), "word").limit(n)


def trending_words(
    df: DataFrame, column: str = "text", n: int = 50, stop_words: Sequence[str] = ENGLISH
) -> DataFrame:
    """Most frequent words of the cleaned texts without stop words; ties are ordered by word."""
    return top_values(_topical_words(df, column, stop_words), "word", n)
