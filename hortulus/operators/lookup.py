"""Looking up single names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hortulus.functions.text import fully_clean
from hortulus.operators.match import match_exact, match_fuzzy
from hortulus.operators.names import authorship_list
from hortulus.plans.extract import Dictionaries


def lookup(strings: DataFrame, column: str, known: Dictionaries, rank: str | None = None, fuzzy: bool = False, include_epithets: bool = False) -> DataFrame:
    """(lookup, score, and what the dictionary of the rank has): exact, or the nearest canonical names (with `include_epithets` an epithet
    that is nearer hides them)."""
    if rank not in (None, "genus", "epithet"):
        raise ValueError("rank is genus, epithet or None")
    if fuzzy:
        cleaned = strings.select(fully_clean(F.col(column)).alias("lookup"))
        found = match_fuzzy(cleaned, "lookup", known.canonical, epithets=known.epithets if include_epithets else None)
    else:
        dictionary = {None: known.canonical, "genus": known.genera, "epithet": known.epithets}[rank]
        found = match_exact(strings.select(F.col(column).alias("lookup")).where("lookup IS NOT NULL"), "lookup", dictionary, rank or "name").withColumn("score", F.lit(1.0))
    return found.withColumn("authorships", authorship_list(F.col("authorships"))) if "authorships" in found.columns else found
