"""String rules: tokenising, title cleaning, safe parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the year that stands for "release year unknown".
UNKNOWN_YEAR = 1900


def split_on_space(text: Column) -> Column:
    """Split on single spaces; inner empty tokens stay, trailing ones go.

    An empty input gives one empty token, an all-space input gives none.
    """
    body = F.rtrim(text, F.lit(" "))
    none = F.array().cast("array<string>")
    return F.when(text == "", F.array(F.lit(""))).when(body == "", none).otherwise(F.split(body, " "))


def words(text: Column) -> Column:
    """Lower-case runs of ASCII word characters."""
    return F.filter(F.split(F.lower(text), r"\W+"), lambda w: w != "")


def title_without_year(title: Column) -> Column:
    """Drop the first ``(digits)`` and trim."""
    return F.trim(F.regexp_replace(title, r"^(.*?)\(\d+\)", "$1"))


def title_before_bracket(title: Column) -> Column:
    """Everything before the first ``(word)``, trimmed; the title itself if there is none."""
    head = F.trim(F.split(title, r"\(\w+\)", 2)[0])
    return F.when(title.rlike(r"\(\w+\)"), head).otherwise(title)


def without_title_marks(title: Column) -> Column:
    """Remove commas, round brackets and colons."""
    return F.translate(title, ",():", "")


def without_quotes(text: Column) -> Column:
    """Remove double quotes."""
    return F.translate(text, '"', "")


def last_chars(text: Column, n: int) -> Column:
    """The last ``n`` characters."""
    return F.right(text, F.lit(n))


def release_year(date_text: Column) -> Column:
    """Last four characters as an integer; unknown-year sentinel when that fails."""
    tail = last_chars(date_text, 4)
    numeric = (F.length(date_text) >= 4) & tail.rlike(r"^[+-]?\d+$")
    return F.when(numeric, tail.try_cast("int")).otherwise(F.lit(UNKNOWN_YEAR))


def number_or_zero(text: Column) -> Column:
    """``?`` stands for a missing number and becomes 0."""
    return F.when(text == "?", F.lit(0.0)).otherwise(text.try_cast("double"))


def joined(tokens: Column, separator: str = " ") -> Column:
    """A list as one string."""
    return F.array_join(tokens, separator)
