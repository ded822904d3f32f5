"""Writers: a delimited table for each document, audit of a run, preprocessed text, requoted files, the dictionaries."""

from __future__ import annotations

import csv
import json
import os
from dataclasses import asdict, dataclass, field
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hortulus.operators.rows import COLUMNS
from hortulus.plans.extract import Dictionaries

FORMATS = {"tsv": "\t", "csv": ","}


def as_text(df: DataFrame) -> DataFrame:
    """All columns as the strings that are written: null as '', truth as True and False, whole scores without a fraction."""

    def of(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "boolean":
            return F.when(c, "True").otherwise(F.when(c.isNotNull(), "False"))
        if kind == "double":
            return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
        return c.cast("string")

    return df.select(*[F.coalesce(of(n, k), F.lit("")).alias(n) for n, k in df.dtypes])


def output_path(path: Column, folder: str | None = None, suffix: str = "tsv") -> Column:
    """Where the table of a document goes: in `folder` under its own name with another suffix, or beside it. The document itself is never
    overwritten (an error)."""
    base = path if folder is None else F.concat(F.lit(f"{folder.rstrip('/')}/"), F.element_at(F.split(path, "/"), -1))
    out = F.concat(F.regexp_replace(base, "\\.[^./]*$", ""), F.lit(f".{suffix}"))
    return F.when(out == path, F.raise_error(F.concat(F.lit("would overwrite "), path))).otherwise(out)


def write_documents(rows: DataFrame, path: str, folder: str | None = None, form: str = "tsv") -> DataFrame:
    """(document, file, n_rows): one file for each document, named as it is, in `folder` (in situ without one); rows carry the document's
    path. Takes a file system that all machines mount; write_rows() serves any other. A document without rows has no file; a file is whole or
    not there, so a task that is run again does no harm. The result is lazy: files are written as it is collected or counted.
    """
    if form not in FORMATS:
        raise ValueError(f"unknown format {form}")
    text = as_text(rows.select(F.col(path).alias("document"), output_path(F.col(path), folder, form).alias("file"), *COLUMNS))
    separator = FORMATS[form]

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        file = frame["file"].iloc[0].removeprefix("file:")
        ordered = frame.assign(at=frame["line"].astype(int)).sort_values("at", kind="stable")[list(COLUMNS)]
        os.makedirs(os.path.dirname(file) or ".", exist_ok=True)
        partial = f"{file}.{os.getpid()}.part"
        with open(partial, "w", encoding="utf-8", newline="") as out:
            writer = csv.writer(out, delimiter=separator)
            writer.writerow(COLUMNS)
            writer.writerows(ordered.itertuples(index=False))
        os.replace(partial, file)
        return pd.DataFrame({"document": [frame["document"].iloc[0]], "file": [file], "n_rows": [len(frame)]})

    return text.groupBy("document").applyInPandas(write, "document string, file string, n_rows long")


def show_rows(rows: DataFrame, most: int = 1000) -> None:
    """Prints the rows of an interactive run, in order."""
    for row in rows.orderBy("filename", "line").limit(most).toLocalIterator():
        print(row.asDict())


def write_envelopes(parsed: DataFrame, folder: str, parser: str) -> None:
    """JSON envelopes (filename, timestamp, parser, document) of (filename, text) from read_binary()."""
    parsed.where("text IS NOT NULL").select(
        "filename", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.lit(parser).alias("parser"), F.struct(F.col("text").alias("content")).alias("document")
    ).write.mode("overwrite").json(folder)


def skip_existing(documents: DataFrame, ident: str, spark: SparkSession, folder: str) -> DataFrame:
    """The documents without rows in a written folder; all if there is none."""
    try:
        done = spark.read.option("header", True).option("basePath", folder).csv(folder).select(F.col("document").cast("string").alias("__done")).distinct()
    except Exception as error:  # nothing was written yet
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return documents
    return documents.join(done, F.col(ident).cast("string") == F.col("__done"), "left_anti")


def write_rows(rows: DataFrame, folder: str, ident: str = "doc", form: str = "tsv", mode: str = "overwrite") -> None:
    """A folder for each document with its table: header, CRLF, quotes where needed. Documents without rows have none.

    Rows are sorted within a document by line; a document is written by one task, documents side by side.
    """
    if form not in FORMATS:
        raise ValueError(f"unknown format {form}")
    ordered = rows.repartition(ident).sortWithinPartitions(ident, "line")
    text = as_text(ordered.select(F.col(ident).alias("document"), *COLUMNS))
    text.write.mode(mode).partitionBy("document").option("sep", FORMATS[form]).option("header", True).option("escape", '"').option("lineSep", "\r\n").option("emptyValue", "").csv(folder)


def write_dictionaries(known: Dictionaries, folder: str) -> None:
    for name in ("canonical", "genera", "epithets"):
        getattr(known, name).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_dictionaries(spark: SparkSession, folder: str) -> Dictionaries:
    return Dictionaries(*(spark.read.parquet(f"{folder}/{name}") for name in ("canonical", "genera", "epithets")))


def write_names(names: DataFrame, folder: str, per_source: bool = False) -> None:
    """The names table; per source only the sources at hand are replaced."""
    writer = names.write.mode("overwrite").partitionBy("source")
    (writer.option("partitionOverwriteMode", "dynamic") if per_source else writer).parquet(folder)


def drop_source(spark: SparkSession, name: str) -> None:
    """The loaded table of a source is dropped if there is one."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def write_preprocessed(parts: DataFrame, ident: str, folder: str) -> None:
    """The split lines of each document in order, as text."""
    parts.repartition(ident).sortWithinPartitions(ident, "line_nr", "part").select(ident, F.col("raw").alias("value")).write.mode("overwrite").partitionBy(ident).text(folder)


def write_requoted(df: DataFrame, path: str, separator: str) -> None:
    df.write.mode("overwrite").option("sep", separator).option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


@dataclass
class JobLog:
    """The audit of a run, written once as JSON."""

    arguments: dict[str, str] = field(default_factory=dict)
    processed: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    output: list[str] = field(default_factory=list)
    counters: dict[str, int] = field(default_factory=dict)
    started: str = field(default_factory=lambda: datetime.now().isoformat(timespec="seconds"))
    ended: str | None = None

    def finish(self, spark: SparkSession, folder: str) -> None:
        self.ended = datetime.now().isoformat(timespec="seconds")
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("append").text(folder)
