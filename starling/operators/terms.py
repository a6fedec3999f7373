"""Term lists of any size: stop words and banned words as a table that is joined, never a list inside an expression.

Texts do not take part in the join. The distinct tokens of a text are paired with its row; a first join finds which of all
tokens in use are terms, each token once, so a token that stands in a third of all texts is one row there; the second
brings these terms to the rows that hold them, and only rows with a term are touched again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.text import mask_runs, runs_of
from starling.session import materialize


def numbered(df: DataFrame) -> DataFrame:
    """Stored with a number for each row, which a row that is read again keeps."""
    return materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def found(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows of `tokens` (column token) whose token is a term."""
    named = terms.select(F.col("term").alias("token")).where("token IS NOT NULL")
    used = tokens.select("token").distinct().join(named, "token", "left_semi")
    return tokens.join(used, "token")


def censor(df: DataFrame, terms: DataFrame, column: str = "content", mask_last: bool = False) -> DataFrame:
    """Star out the inside of banned words in a column, as functions.text.censor does for a list of words.

    Terms are lower case; those of one or two letters are left alone.
    """
    rows = numbered(df)
    used = rows.select("_row", F.explode(F.array_distinct(F.transform(runs_of(F.col(column)), F.lower))).alias("token"))
    long = terms.where(F.length("term") > 2)
    hits = found(used.where(F.length("token") > 2), long).groupBy("_row").agg(F.collect_set("token").alias("_banned"))
    joined = rows.join(hits, "_row", "left")
    masked = mask_runs(F.col(column), lambda run: F.array_contains("_banned", run), mask_last)
    value = F.when(F.col("_banned").isNull(), F.col(column)).otherwise(masked)
    return joined.withColumn(column, value).select(*df.columns)


def counted(words: DataFrame, terms: DataFrame) -> DataFrame:
    """Per row (_row, with array `words`) how many of its words are terms, as _stopped; rows without any are left out."""
    used = words.select("_row", F.explode("words").alias("token")).groupBy("_row", "token").agg(F.count("*").alias("times"))
    return found(used, terms).groupBy("_row").agg(F.sum("times").alias("_stopped"))


def without(df: DataFrame, terms: DataFrame, column: str = "word") -> DataFrame:
    """Rows whose value is no term."""
    return df.join(terms.select(F.col("term").alias(column)).where(F.col(column).isNotNull()), column, "left_anti")

