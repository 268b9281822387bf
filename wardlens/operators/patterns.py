"""Texts matched against a table of patterns.

A predicate per word, as in ``contains_any``, is right for a few words. A table
of thousands of patterns is joined instead, by character grams: each pattern is
looked up by the gram of it that the fewest texts hold, so a text meets only the
patterns whose rarest gram it has, and each such pair is then compared. Equal
texts are compared once, however many rows hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The distinct character grams of a size."""
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - size + 1, F.lit(1)))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(size))))
    return F.when(F.char_length(text) >= size, grams)


def match_patterns(rows: DataFrame, patterns: DataFrame, text_col: str, pattern_col: str = "pattern",
                   gram: int = GRAM) -> DataFrame:
    """(text, pattern): which distinct texts of ``rows`` hold which distinct
    patterns of ``patterns``, without regard to case. Null texts hold none;
    patterns shorter than a gram are looked up whole, empty ones are left out.
    Join the result to the rows by their text.
    """
    texts = (rows.select(F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
             .withColumn("low", F.lower("text")))
    wanted = (patterns.select(F.col(pattern_col).alias("pattern")).where("pattern IS NOT NULL").distinct()
              .withColumn("find", F.lower("pattern")))
    # Grams of patterns: of the full size, or the whole of a shorter one.
    own = F.when(F.char_length("find") >= gram, _grams(F.col("find"), gram)).otherwise(F.array("find"))
    parts = wanted.where("find <> ''").select("pattern", "find", F.explode(own).alias("gram"))
    sizes = F.flatten(F.array_compact(F.array(*[_grams(F.col("low"), n) for n in range(1, gram + 1)])))
    asked = parts.select("gram").distinct()
    held = (texts.select("text", "low", F.explode(sizes).alias("gram"))
            .join(asked, "gram", "left_semi"))
    frequency = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # A pattern with a gram that no text holds is in none.
    rarest = (parts.join(frequency, "gram", "left").groupBy("pattern", "find")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("least"))
              .where("least.n > 0").select("pattern", "find", F.col("least.gram").alias("gram")))
    return (held.join(rarest, "gram").where(F.contains(F.col("low"), F.col("find")))
            .select("text", "pattern"))


def rows_matching(rows: DataFrame, patterns: DataFrame, text_col: str,
                  pattern_col: str = "pattern") -> DataFrame:
    """The rows whose text holds any of the patterns."""
    hits = match_patterns(rows, patterns, text_col, pattern_col).select(
        F.col("text").alias("_hit")).distinct()
    return rows.join(hits, F.col(text_col) == F.col("_hit"), "left_semi")
