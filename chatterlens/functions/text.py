"""Column functions over message text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what the cleaning step removes, everything but ASCII letters and whitespace. Lower-cased text
# holds no capitals, so the class need not name them; the shorter class is matched some ten times faster.
NOT_LETTERS = "[^a-z\\s]+"

# Fixed value: characters that leave something after lower-casing and cleaning. The last two are the only
# ones outside ASCII whose lower case holds an ASCII letter.
LETTERS = "[a-zA-Z\\s\u0130\u212a]"

# Fixed value: characters that count as blank in the validity rule.
BLANKS = " \t\r\n"

# Fixed value: every character that Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: shorter texts are not sent to a model.
SHORT_TEXT = 5


def clean_text(text: Column) -> Column:
    """Lower case, ASCII letters and whitespace only."""
    return F.regexp_replace(F.lower(text), NOT_LETTERS, "")


def with_clean_text(df: DataFrame, source: str = "text", target: str = "comment_clean") -> DataFrame:
    """Add the cleaned text; a null text becomes empty because the tokenizer refuses nulls."""
    return df.withColumn(target, F.coalesce(clean_text(F.col(source)), F.lit("")))


def drop_empty_text(df: DataFrame, source: str = "text") -> DataFrame:
    """Keep rows whose cleaned text is not empty. Whitespace alone passes, null does not.

    The test looks for one character that cleaning would keep and stops there, instead of cleaning twice.
    """
    return df.filter(F.col(source).rlike(LETTERS))


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text; never null."""
    return F.coalesce(F.btrim(text, F.lit(BLANKS)) == "", F.lit(True))


def is_short(text: Column, limit: int = SHORT_TEXT) -> Column:
    """True for null text and text under ``limit`` characters; never null."""
    return F.coalesce(F.length(text) < limit, F.lit(True))


def strip(text: Column) -> Column:
    """Remove whitespace at both ends, all kinds of it."""
    return F.btrim(text, F.lit(PYTHON_WHITESPACE))


def before_first(text: Column, mark: str) -> Column:
    """Text left of the first ``mark``, or all of it when the mark is missing."""
    return F.substring_index(text, mark, 1)


def after_first(text: Column, mark: str) -> Column:
    """Text right of the first ``mark``, or null when the mark is missing."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substring(text, at + F.lit(len(mark)), F.length(text)))


def remove_mark(text: Column, mark: str) -> Column:
    return F.replace(text, F.lit(mark), F.lit(""))


def truncate(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def model_title(name: Column) -> Column:
    """``Naive_Bayes`` reads as ``Naive Bayes``."""
    return F.replace(name, F.lit("_"), F.lit(" "))


def percent_text(share: Column) -> Column:
    """0.7095 reads as ``70.95%``."""
    return F.format_string("%.2f%%", share * 100)


def each(items: Column) -> Column:
    """One row per item; a row without items gives one null.

    For a plain explode the optimizer adds a filter on the array's size, which computes the array a second and a
    third time. Where the array is a tokenised text, leaving out the null afterwards is far cheaper.
    """
    return F.explode_outer(items)


def words_of(clean: Column) -> Column:
    """Words of a cleaned text, split at any run of whitespace."""
    return F.split(clean, "\\s+")


def content_key(*columns: str) -> Column:
    """Digest of the named columns, used as document id."""
    return F.md5(F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
