"""Score to class rules.

The four rules differ on fractional and out-of-range scores, so each has its
own function; pick by the job at hand.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTIMENTS = ("negative", "neutral", "positive")

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    The guard keeps out forms that only Spark's cast accepts, such as '5d'.
    """
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def sentiment(score: Column) -> Column:
    """<= 2 negative, 3 neutral, anything else positive; null stays null."""
    return F.when(score <= 2, "negative").when(score == 3, "neutral").when(score.isNotNull(), "positive")


def class_label(score: Column) -> Column:
    """0 / 1 / 2 for <= 2, == 3, >= 4; a score between the bands gets 0."""
    return F.when(score <= 2, 0).when(score == 3, 1).when(score >= 4, 2).otherwise(0)


def score_band(score: Column) -> Column:
    """Band used to count classes for balancing; scores between bands get null."""
    return F.when(score >= 4, "positive").when(score == 3, "neutral").when(score <= 2, "negative")
