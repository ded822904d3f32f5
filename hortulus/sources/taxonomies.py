"""Source taxonomies as delimited files, and the names table made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hortulus.operators.names import SOURCES, Source, clean_names, normalise_ranks, read_source, union_sources

SEPARATORS = (";", ",", "\t", "|")
SAMPLE = 4096


def sniff_separator(sample: str) -> str:
    """The separator that stands equally often in every whole line of the sample, the most frequent of several."""
    rows = [r for r in sample[:SAMPLE].split("\n")[:-1] or [sample] if r.strip()]
    counts = {s: {r.count(s) for r in rows} for s in SEPARATORS}
    steady = {s: min(c) for s, c in counts.items() if len(c) == 1 and min(c) > 0}
    chosen = steady or {s: min(c) for s, c in counts.items() if c and min(c) > 0}
    if not chosen:
        raise ValueError("no separator found")
    return max(chosen, key=lambda s: chosen[s])


def read_delimited(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    if separator is None:
        head = spark.read.text(path).limit(50).collect()
        separator = sniff_separator("\n".join(r.value for r in head) + "\n")
    return spark.read.option("sep", separator).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def load_source(spark: SparkSession, name: str, path: str, spec: Source | None = None) -> DataFrame:
    spec = spec or SOURCES[name]
    return read_source(read_delimited(spark, path, spec.separator), name, spec)


def build_names(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The names of the sources at hand in load order, ranks normalised, cleaned; unknown and disabled sources are refused, those whose file
    is missing are left out."""
    wrong = [n for n in paths if n not in SOURCES or not SOURCES[n].enabled]
    if wrong:
        raise ValueError(f"unusable sources {wrong}")
    parts = [load_source(spark, n, paths[n]) for n in SOURCES if n in paths and there(spark, paths[n])]
    if not parts:
        raise ValueError("no source is there")
    return clean_names(normalise_ranks(union_sources(parts))).withColumn("ord", F.monotonically_increasing_id())


def there(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
