"""The commands: extract entries from documents, build the names table from taxonomies, look up names.

    python -m hortulus extract DOCUMENTS NAMES --sources PRIORITIES (--output FOLDER | --in-situ | --stdout)
    python -m hortulus names FOLDER SOURCE=FILE ... [--per-source] [--drop]
    python -m hortulus lookup NAMES --sources PRIORITIES [STRING ...]     # without strings: reads them line by line
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hortulus.functions.text import garden_of, year_of
from hortulus.operators.lookup import lookup
from hortulus.operators.match import Fuzzy
from hortulus.operators.names import with_priority
from hortulus.plans.extract import Dictionaries, Options, dictionaries, extract
from hortulus.runtime import cut_lineage, workers_find_package
from hortulus.sources import documents, sinks, taxonomies


def known_names(spark: SparkSession, given: argparse.Namespace) -> Dictionaries:
    """From the cache if there is one; else made of the names table, and written to the cache if one is named."""
    if given.cache and taxonomies.there(spark, f"{given.cache}/epithets/_SUCCESS"):
        return sinks.read_dictionaries(spark, given.cache)
    known = dictionaries(with_priority(spark.read.parquet(given.names), spark.read.parquet(given.sources)))
    if given.cache:
        sinks.write_dictionaries(known, given.cache)
    return known


def run_extract(spark: SparkSession, given: argparse.Namespace) -> None:
    log = sinks.JobLog(arguments={k: str(v) for k, v in vars(given).items() if k != "run"})
    folder = None if given.in_situ else given.output
    found = documents.read_documents(spark, given.documents)
    if given.skip_existing:
        found = cut_lineage(found.withColumn("out", sinks.output_path(F.col("path"), folder, given.format)))
        there = F.udf(lambda p: __import__("os").path.exists(p.removeprefix("file:")), "boolean")
        marked = cut_lineage(found.withColumn("done", there("out")))
        log.skipped = [r.path for r in marked.where("done").select("path").orderBy("path").toLocalIterator()]
        found = marked.where("NOT done").drop("out", "done")
    found = cut_lineage(found)
    states = documents.document_states(found)
    log.failed = [r.path for r in states.where("state = 'failed'").orderBy("path").toLocalIterator()]
    log.processed = [r.path for r in states.where("state <> 'failed'").orderBy("path").toLocalIterator()]
    lines = cut_lineage(documents.document_lines(found)).select(
        F.col("path").alias("doc"), "line_nr", F.col("raw"), "filename", garden_of(F.col("filename")).alias("garden_code"), year_of(F.col("filename")).alias("year")
    )
    fuzzy = Fuzzy(threshold=given.threshold, strategy=given.strategy, near_blocks=given.near_blocks) if given.threshold else None
    options = Options(codes=not given.no_codes, fuzzy=fuzzy, field_order=("ipen", "name") if given.codes_first else ("name", "ipen"))
    counters = Observation("names")
    named = F.col("match_name").isNotNull()
    rows = extract(lines, known_names(spark, given), options).observe(
        counters, F.count(F.lit(1)).alias("rows"), F.count_if(named & (F.col("match_score") == 1)).alias("exact"), F.count_if(named & (F.col("match_score") < 1)).alias("fuzzy")
    )
    if given.stdout:
        sinks.show_rows(rows)
    else:
        log.output = [r.file for r in sinks.write_documents(rows, "doc", folder, given.format).orderBy("file").collect()]  # one row a document
        log.counters = {k: int(v) for k, v in counters.get.items()}
    if given.log:
        log.finish(spark, given.log)


def run_names(spark: SparkSession, given: argparse.Namespace) -> None:
    paths = dict(s.split("=", 1) for s in given.source)
    sinks.write_names(taxonomies.build_names(spark, paths), given.folder, per_source=given.per_source)
    if given.drop:
        for name in paths:
            sinks.drop_source(spark, taxonomies.SOURCES[name].table)
    print(spark.read.parquet(given.folder).count(), "names")


def found_lines(found: DataFrame) -> Iterable[str]:
    for row in found.orderBy(F.col("score").desc()).limit(20).collect():
        shown = row.asDict()
        yield f"{shown.get('lookup')} --> {shown.get('canonical_name') or shown.get('epithet')} ({shown.get('score')}) {shown.get('authorships') or ''}".rstrip()


def run_lookup(spark: SparkSession, given: argparse.Namespace) -> None:
    known = known_names(spark, given)

    def answer(strings: list[str], rank: str | None, fuzzy: bool) -> bool:
        lines = list(found_lines(lookup(spark.createDataFrame([(s,) for s in strings], "s string"), "s", known, rank, fuzzy)))
        print("\n".join(lines) or "no match")
        return bool(lines)

    if given.string:
        answer(given.string if given.fuzzy else given.string[:1], given.rank, given.fuzzy)
        return
    before = ""  # e+, g+ and f+ look among epithets, genera and nearest names; a blank line repeats what failed as nearest; q ends
    for line in sys.stdin:
        text = line.strip()
        if text == "q":
            return
        if not text and before:
            answer([before], None, True)
            before = ""
        elif text:
            prefix, string = (text[:2], text[2:].strip()) if text[:2] in ("e+", "g+", "f+") else ("", text)
            met = answer([string], {"e+": "epithet", "g+": "genus"}.get(prefix), prefix == "f+")
            before = "" if met or prefix == "f+" else string


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hortulus", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(required=True)
    one = commands.add_parser("extract")
    one.set_defaults(run=run_extract)
    one.add_argument("documents")
    one.add_argument("names", help="Parquet table of names with ord")
    where = one.add_mutually_exclusive_group(required=True)
    where.add_argument("--output")
    where.add_argument("--in-situ", action="store_true")
    where.add_argument("--stdout", action="store_true")
    one.add_argument("--format", default="tsv", choices=sorted(sinks.FORMATS))
    one.add_argument("--skip-existing", action="store_true")
    one.add_argument("--no-codes", action="store_true")
    one.add_argument("--threshold", type=float)
    one.add_argument("--strategy", default="best_score")
    one.add_argument("--near-blocks", action="store_true")
    one.add_argument("--codes-first", action="store_true")
    one.add_argument("--log", help="folder of the job log")
    two = commands.add_parser("names")
    two.set_defaults(run=run_names)
    two.add_argument("folder")
    two.add_argument("source", nargs="+", help="NAME=FILE")
    two.add_argument("--per-source", action="store_true", help="replace the sources given only")
    two.add_argument("--drop", action="store_true", help="drop the loaded tables of the sources")
    three = commands.add_parser("lookup")
    three.set_defaults(run=run_lookup)
    three.add_argument("names")
    three.add_argument("string", nargs="*")
    three.add_argument("--rank", choices=("genus", "epithet"))
    three.add_argument("--fuzzy", action="store_true")
    for command in (one, three):
        command.add_argument("--sources", required=True, help="Parquet table (source, priority)")
        command.add_argument("--cache", help="folder of ready-made dictionaries")
    return top


def main(arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("hortulus").getOrCreate()
    workers_find_package(spark)
    given.run(spark, given)


if __name__ == "__main__":
    main()
