"""From source taxonomies to the dictionaries that names are looked up in."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hortulus.functions.text import LONE_X, name_key, strip

FIELDS = ("canonical_name", "genus", "epithet", "infraspecific_epithet", "authorship")
# The ranks that names are matched at.
MATCHABLE = ("genus", "species", "subspecies", "form", "variety")


@dataclass(frozen=True)
class Source:
    """How a taxonomy is read: its table, its columns in the order of FIELDS and rank, a filter, and its ranks in ours."""

    table: str
    columns: tuple[str, ...]
    ranks: dict[str, tuple[str, ...]]
    where: str = "true"
    separator: str = "\t"
    enabled: bool = True
    options: dict[str, str] = field(default_factory=dict)


_DWC = ("scientificName", "genus", "specificEpithet", "infraspecificEpithet", "scientificNameAuthorship", "taxonRank")
# Tables, columns and ranks of the public taxonomies, misspelt column names included. In load order.
SOURCES = {
    "WCVP": Source(
        "wcvp_taxon",
        ("scientfiicname", "genus", "specificepithet", "infraspecificepithet", "scientfiicnameauthorship", "taxonrank"),
        {
            "genus": ("genus",),
            "species": ("species",),
            "subspecies": ("subspecies", "nothosubsp."),
            "form": ("form", "subform", "nothof."),
            "variety": ("variety", "subvariety", "convariety", "nothovar.", "provar."),
            "prole": ("proles", "subproles"),
        },
        separator="|",
    ),
    "WFO": Source(
        "WFO_classification",
        _DWC,
        {
            "family": ("family", "subfamily"),
            "genus": ("genus", "subgenus"),
            "species": ("species",),
            "subspecies": ("subspecies",),
            "form": ("form", "subform"),
            "variety": ("variety", "subvariety"),
            "prole": ("prole",),
        },
    ),
    "CoL": Source(
        "CoL_NameUsage",
        ("col:scientificName", "col:genericName", "col:specificEpithet", "col:infraspecificEpithet", "col:authorship", "col:rank"),
        {
            "family": ("family", "subfamily", "epifamily", "superfamily"),
            "genus": ("genus", "subgenus"),
            "species": ("species", '"species aggregate"'),
            "subspecies": ("subspecies",),
            "form": ("form", "subform"),
            "variety": ("variety", "subvariety"),
            "prole": ("proles",),
        },
        where="`col:code` = 'botanical'",
    ),
    "GBIF": Source(
        "GBIF_Taxon",
        ("canonicalName", "genericName", *_DWC[2:]),
        {
            "family": ("family",),
            "genus": ("genus",),
            "species": ("species",),
            "subspecies": ("subspecies",),
            "form": ("form",),
            "variety": ("variety",),
        },
        where="kingdom = 'Plantae' AND taxonRank <> 'unranked'",
    ),
    "PlantList": Source("PlantList", _DWC, {"species": ("species",), "subspecies": ("subspecies",), "form": ("f.",), "variety": ("variety", "var")}),
    # has no genus column, so it is not loaded
    "IPNI": Source("IPNI_Name", ("col:scientificName", "", "", "", "col:authorship", "col:rank"), {}, enabled=False),
}


def read_source(raw: DataFrame, name: str, source: Source) -> DataFrame:
    """The columns of a source's own table under our names, with the rank in lower case."""
    picked = raw.where(source.where)
    columns = [F.col(f"`{c}`") if c else F.lit("") for c in source.columns]
    return picked.select(*[c.cast("string").alias(n) for c, n in zip(columns, FIELDS)], F.lower(columns[-1]).alias("taxon_rank"), F.lit(name).alias("source"))


def rank_table(spark: SparkSession) -> DataFrame:
    """(source, raw_rank, taxon_rank): fixed, some thirty rows; the first rank that lists a raw one counts."""
    rows = {(s, raw): rank for s, spec in SOURCES.items() for rank, raws in reversed(spec.ranks.items()) for raw in raws}
    return spark.createDataFrame([(s, raw, rank) for (s, raw), rank in rows.items()], "source string, raw_rank string, taxon_rank string")


def normalise_ranks(names: DataFrame) -> DataFrame:
    """Our rank for each source's own; rows of other ranks are dropped."""
    raw = names.withColumn("raw_rank", F.lower("taxon_rank")).drop("taxon_rank")
    return raw.join(F.broadcast(rank_table(names.sparkSession)), ["source", "raw_rank"]).drop("raw_rank")


def clean_names(names: DataFrame) -> DataFrame:
    """A lone x is a hybrid sign; empty strings are null."""
    nulls = {c: F.nullif(F.col(c), F.lit("")) for c in FIELDS[1:]}
    return names.withColumns({"canonical_name": strip(F.regexp_replace("canonical_name", LONE_X, " × "))} | nulls)


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """All rows of all sources; repeated names stay."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_priority(names: DataFrame, priorities: DataFrame) -> DataFrame:
    """`prio` of each source; unknown sources come first, as nulls do when sorted."""
    known = priorities.groupBy("source").agg(F.min("priority").cast("int").alias("prio"))
    return names.join(F.broadcast(known), "source", "left").withColumn("prio", F.coalesce("prio", F.lit(-1)))


def matchable(names: DataFrame) -> DataFrame:
    return names.where(F.col("canonical_name").isNotNull() & F.col("genus").isNotNull() & F.col("taxon_rank").isin(*MATCHABLE))


def _authorships(names: DataFrame, key: str) -> DataFrame:
    """(key, authorships): the distinct (authorship, source) of each key in order of priority. Distinct pairs are aggregated
    first, so a key with very many rows collects only as many entries as it has different authors."""
    each = names.groupBy(key, "authorship", "source").agg(F.min(F.struct("prio", "ord")).alias("at"))
    entries = F.sort_array(F.collect_list(F.struct("at", "authorship", "source")))
    return each.groupBy(key).agg(F.transform(entries, lambda e: F.struct(e["authorship"], e["source"])).alias("authorships"))


def first_wins(names: DataFrame, key: Column) -> DataFrame:
    """A dictionary by key: the first row in order of priority, with all authorships and its place in that order (prio, ord)."""
    keyed = names.withColumn("key", key).where("key <> ''")
    best = keyed.groupBy("key").agg(F.min_by(F.struct(*FIELDS, "taxon_rank", "source", "prio", "ord"), F.struct("prio", "ord")).alias("m"))
    return best.select("key", "m.*").join(_authorships(keyed, "key"), "key")


def canonical_dictionary(names: DataFrame) -> DataFrame:
    return first_wins(matchable(names), name_key(F.col("canonical_name")))


def genus_dictionary(names: DataFrame) -> DataFrame:
    return first_wins(matchable(names).where("taxon_rank = 'genus'"), name_key(F.col("canonical_name")))


def epithet_dictionary(names: DataFrame) -> DataFrame:
    """By cleaned epithet and infraspecific epithet: the last row in order of priority, the reverse of the others."""
    with_epithet = matchable(names).where("epithet IS NOT NULL")
    keyed = with_epithet.withColumn("key", name_key(F.concat_ws(" ", "epithet", "infraspecific_epithet"))).where("key <> ''")
    best = keyed.groupBy("key").agg(F.max_by(F.struct("epithet", "infraspecific_epithet", "taxon_rank", "source"), F.struct("prio", "ord")).alias("m"))
    return best.select("key", "m.*")


def authorship_list(authorships: Column) -> Column:
    """'author [source]; ...', of equal authors the first source. A null author is written None, as the original does."""
    name = lambda e: F.coalesce(e["authorship"], F.lit("None"))
    firsts = F.filter(authorships, lambda e, i: ~F.exists(F.slice(authorships, F.lit(1), i), lambda b: name(b) == name(e)))
    return F.array_join(F.transform(firsts, lambda e: F.concat(name(e), F.lit(" ["), F.coalesce(e["source"], F.lit("None")), F.lit("]"))), "; ")


def full_name(canonical: Column, authorship: Column) -> Column:
    return strip(F.concat(canonical, F.lit(" "), F.coalesce(authorship, F.lit(""))))


def is_hybrid(canonical: Column, authorship: Column) -> Column:
    return full_name(canonical, authorship).contains(" × ")
