"""Texts of several tables as one relation, their words, and texts rebuilt from replaced words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: {name of the table: (table, ident, text, source)}
Tables = dict[str, tuple[DataFrame, str, str, str]]
#: What separates words: blanks, line ends and the edges of markup.
BLANKS = " \\t\\r\\n<>"


def one_relation(tables: Tables) -> DataFrame:
    """(table_name, row_id, source, text); a null source is ''. Other columns are dropped, so no name can clash."""
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            F.col(f"`{ident}`").cast("long").alias("row_id"),
            F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
            F.col(f"`{text}`").cast("string").alias("text"),
        )
        for name, (df, ident, text, source) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def matching_words(text: str, pattern: str) -> Column:
    """The words (between blanks and line ends) of a text that hold a match of the pattern."""
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w.rlike(pattern))


def replace_words(texts: DataFrame, pattern: str, replacements: DataFrame, by: list[str], to: str) -> DataFrame:
    """(table_name, row_id, text): the rows with a word of `replacements` (columns `by`, which hold "word", and `to`), with all
    such words replaced. Blanks stay as they are.

    Only the matching words of a row are exploded and joined; what is to be replaced comes back to its text as a map, and the text is
    rebuilt within its row.
    """
    rows = texts.where(F.col("text").rlike(pattern)).withColumn("__key", F.xxhash64("text"))
    held = rows.select("table_name", "row_id", "__key", "source", F.explode(F.array_distinct(matching_words("text", pattern))).alias("word")).distinct()
    met = held.join(replacements.select(*by, F.col(to).alias("__to")), by)
    fixes = met.groupBy("table_name", "row_id", "__key").agg(F.map_from_entries(F.collect_set(F.struct("word", "__to"))).alias("fixes"))
    pieces = F.regexp_extract_all("text", F.lit(f"[{BLANKS}]+|[^{BLANKS}]+"), F.lit(0))
    built = F.array_join(F.transform(pieces, lambda w: F.coalesce(F.element_at("fixes", w), w)), "")
    return rows.join(fixes, ["table_name", "row_id", "__key"]).select("table_name", "row_id", built.alias("text")).distinct()


def rows_with_words(texts: DataFrame, pattern: str, words: DataFrame, by: list[str]) -> DataFrame:
    """(table_name, row_id): the rows that hold one of the words."""
    held = texts.where(F.col("text").rlike(pattern)).select("table_name", "row_id", "source", F.explode(F.array_distinct(matching_words("text", pattern))).alias("word"))
    return held.join(words.select(*by), by, "left_semi").select("table_name", "row_id").distinct()
