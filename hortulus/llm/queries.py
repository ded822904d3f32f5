"""The queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hortulus.llm import bpe, encoding, linking, lookalike, mixing, ocr, records, splitting
from hortulus.llm.words import Tables
from hortulus.runtime import table

NAME = ("canonical_name", "genus", "epithet", "infraspecific_epithet", "taxon_rank")


def _representatives(spark: SparkSession, folder: str, policy: str) -> DataFrame:
    names = table(spark, folder, "name_lookup")
    fields = {
        # canonical_name and source come of one row: they are one field
        "name": (F.concat_ws("\u0001", F.coalesce("canonical_name", F.lit("")), F.coalesce("source", F.lit(""))), F.lit(True)),
        "authorship": (F.col("authorship"), records.names_an_author(F.col("authorship"))),
    }
    return records.best_representatives(names, table(spark, folder, "name_sources"), "ord", records.name_key(*NAME), fields, policy=policy)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    best = _representatives(spark, folder, "precedence")
    return best.select("group_ord", "name_ord", F.coalesce("authorship_ord", F.lit(-1).cast("long")).alias("authorship_ord"))


def p1_voted(spark: SparkSession, folder: str) -> DataFrame:
    best = _representatives(spark, folder, "votes")
    name = F.split("name", "\u0001")
    return best.select("group_ord", "copies", name[0].alias("canonical_name"), name[1].alias("source"), "authorship")


def _texts(spark: SparkSession, folder: str, *names: str) -> Tables:
    columns = {"document_lines": ("line_id", "raw_line"), "seedlist_files": ("file_id", "content"), "list_entries": ("entry_id", "extracted_name")}
    return {name: (table(spark, folder, name), *columns[name], "garden_code") for name in names}


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.find_garbled(_texts(spark, folder, "document_lines", "seedlist_files"))


def p2_restored(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.restore_garbled(_texts(spark, folder, "document_lines", "seedlist_files"))


def _noise(spark: SparkSession, folder: str) -> tuple:
    names = ("document_lines", "seedlist_files", "list_entries")
    listed = table(spark, folder, "reference_names").select(F.col("canonical_name").alias("name"), F.lit(True).alias("trusted"))
    looked_up = table(spark, folder, "name_lookup").select(F.col("canonical_name").alias("name"), F.lit(False).alias("trusted"))
    return (_texts(spark, folder, *names), *names, listed.unionByName(looked_up))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return ocr.find_noise(*_noise(spark, folder))


def p3_pages(spark: SparkSession, folder: str) -> DataFrame:
    return ocr.repair_pages(*_noise(spark, folder))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.find_lookalikes(_texts(spark, folder, "document_lines", "list_entries"))


def p5_unified(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.unify_lookalikes(_texts(spark, folder, "document_lines", "list_entries"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    open_entries = table(spark, folder, "list_entries").where("match_name IS NULL")
    return linking.link_rows(open_entries, "entry_id", "extracted_name", table(spark, folder, "reference_names"))


def _record_key():
    return records.record_key(*NAME, ["authorship", "source"])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return records.copy_pairs(table(spark, folder, "name_lookup"), "ord", _record_key())


def p4_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    return records.collapse_copies(table(spark, folder, "name_lookup"), "ord", _record_key())


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_texts(table(spark, folder, "documents"), "doc_id", "text")


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"), table(spark, folder, "source_weights"))[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"), table(spark, folder, "source_weights"))[1]


def p9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_texts(table(spark, folder, "documents"), table(spark, folder, "size_limits"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """By name."""
    return {f.__name__: f for f in (p1_found, p1_voted, p2_found, p2_restored, p3_found, p3_pages, p4_found, p4_collapsed, p5_found, p5_unified, p6_found, p7_ids, p8_mix, p8_shares, p9_pieces)}
