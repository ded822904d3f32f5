"""The queries of the core operators over the test tables, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hortulus.functions import text as tx
from hortulus.operators import context, legend, match, names, rows
from hortulus.plans import extract as plan
from hortulus.runtime import cut_lineage, table
from hortulus.sources import documents

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(function: Query) -> Query:
    _queries[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    """By name; each takes (spark, folder)."""
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query."""
    from hortulus.oracles import oracle_sql as of

    return of()


# ---------------------------------------------------------------- inputs


def source_names(spark: SparkSession, folder: str) -> DataFrame:
    """The names of all sources, ranks normalised and cleaned, with prio and ord."""
    raw = table(spark, folder, "name_lookup")
    return names.with_priority(names.clean_names(names.normalise_ranks(raw)), table(spark, folder, "name_sources"))


def lines_of(spark: SparkSession, folder: str) -> DataFrame:
    """(doc, line_nr, raw, filename, garden_code, year): the lines of text files (of one delivered twice the later row) and of the contents of
    json files, plain or XHTML."""
    files = table(spark, folder, "seedlist_files")
    of_text = table(spark, folder, "document_lines").groupBy(F.col("file_id").alias("doc"), "line_nr").agg(F.max_by("raw_line", "line_id").alias("raw"))
    of_json = documents.content_lines(files.where("file_format = 'json' AND content IS NOT NULL"), "file_id", "content").select(F.col("file_id").alias("doc"), F.col("line_nr").cast("int").alias("line_nr"), "raw")
    named = of_text.unionByName(of_json).join(files.select(F.col("file_id").alias("doc"), "filename"), "doc", "left")
    return named.select(
        "doc", "line_nr", F.coalesce("raw", F.lit("")).alias("raw"), "filename", tx.garden_of(F.col("filename")).alias("garden_code"), tx.year_of(F.col("filename")).alias("year")
    )


def _recognised(spark: SparkSession, folder: str) -> DataFrame:
    return plan.recognise(lines_of(spark, folder), plan.dictionaries(source_names(spark, folder)))


def _in_context(spark: SparkSession, folder: str) -> DataFrame:
    return cut_lineage(plan.with_context(cut_lineage(_recognised(spark, folder))))


# ---------------------------------------------------------------- names


@query
def names_rank_filter(spark: SparkSession, folder: str) -> DataFrame:
    return names.normalise_ranks(table(spark, folder, "name_lookup")).select("ord", "source", "taxon_rank")


@query
def names_clean(spark: SparkSession, folder: str) -> DataFrame:
    return source_names(spark, folder).select("ord", *names.FIELDS, "taxon_rank", "source", "prio")


@query
def names_union(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "reference_names").select(*names.FIELDS, "taxon_rank", F.lit("list").alias("source"))
    looked_up = source_names(spark, folder).select(*names.FIELDS, "taxon_rank", "source")
    return names.union_sources([looked_up, listed]).groupBy("source", "taxon_rank").agg(F.count(F.lit(1)).alias("n_names"))


@query
def canonical_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return names.canonical_dictionary(source_names(spark, folder)).drop("authorships", "prio", "ord")


@query
def genus_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return names.genus_dictionary(source_names(spark, folder)).drop("authorships", "prio", "ord")


@query
def epithet_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return names.epithet_dictionary(source_names(spark, folder))


@query
def authorship_list(spark: SparkSession, folder: str) -> DataFrame:
    known = names.canonical_dictionary(source_names(spark, folder))
    return known.select("key", names.authorship_list(F.col("authorships")).alias("match_authorship"), names.is_hybrid(F.col("canonical_name"), F.col("authorship")).alias("is_hybrid"))


# ---------------------------------------------------------------- scalar functions


@query
def lines_explode(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.posexplode(tx.split_lines(F.col("text"))).alias("line_nr", "raw"))


def _of_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "document_lines").where("raw_line IS NOT NULL").select("line_id", F.col("raw_line").alias("t"))


@query
def line_preprocess(spark: SparkSession, folder: str) -> DataFrame:
    return _of_lines(spark, folder).select("line_id", tx.preprocess_line(F.col("t")).alias("pre"))


@query
def name_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("t")
    return _of_lines(spark, folder).select(
        "line_id", tx.fully_clean(t).alias("fully"), tx.single_blanks(t).alias("single"), tx.drop_abbreviations(t).alias("short"), tx.clean_name(t).alias("letters")
    )


@query
def outer_trim(spark: SparkSession, folder: str) -> DataFrame:
    return _of_lines(spark, folder).select("line_id", tx.trim_outer(F.col("t")).alias("inner_text"))


@query
def line_parts(spark: SparkSession, folder: str) -> DataFrame:
    pre = tx.preprocess_line(F.col("t"))
    return _of_lines(spark, folder).select(
        "line_id",
        F.array_join(tx.synonym_strings(pre), "|").alias("synonyms"),
        tx.cultivar(pre).alias("cultivar"),
        tx.ipen(pre).alias("ipen"),
        tx.position_of(tx.ipen(pre), pre).alias("ipen_at"),
        F.array_join(tx.repeat_symbols(pre), "").alias("repeats"),
    )


@query
def filename_vars(spark: SparkSession, folder: str) -> DataFrame:
    f = F.col("filename")
    return table(spark, folder, "seedlist_files").select("file_id", tx.garden_of(f).alias("garden"), tx.year_of(f).alias("year"))


# ---------------------------------------------------------------- matching


def _lookups(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "list_entries").where("extracted_name IS NOT NULL").select("entry_id", "extracted_name")


@query
def exact_canonical(spark: SparkSession, folder: str) -> DataFrame:
    known = names.canonical_dictionary(source_names(spark, folder)).select("key", "canonical_name", "taxon_rank", "source")
    return match.match_exact(_lookups(spark, folder), "extracted_name", known).select("entry_id", "canonical_name", "taxon_rank", "source")


@query
def exact_genus(spark: SparkSession, folder: str) -> DataFrame:
    known = names.genus_dictionary(source_names(spark, folder)).select("key", "genus", "source")
    words = _lookups(spark, folder).select("entry_id", F.element_at(F.split("extracted_name", " "), 1).alias("word"))
    return match.match_exact(words, "word", known, "genus").select("entry_id", "genus", "source")


@query
def exact_epithet(spark: SparkSession, folder: str) -> DataFrame:
    known = names.epithet_dictionary(source_names(spark, folder)).select("key", "epithet", "infraspecific_epithet", "source")
    words = _lookups(spark, folder).select("entry_id", F.element_at(F.split("extracted_name", " "), -1).alias("word"))
    return match.match_exact(words, "word", known, "epithet").select("entry_id", "epithet", "infraspecific_epithet", "source")


@query
def leftmost_longest(spark: SparkSession, folder: str) -> DataFrame:
    known = plan.dictionaries(source_names(spark, folder))
    pre = lines_of(spark, folder).select("doc", "line_nr", tx.preprocess_line(F.col("raw")).alias("text"))
    hits = match.leftmost_longest(pre, ["doc", "line_nr"], "text", known.together, known.most_words(), known.bits)
    return hits.select("doc", "line_nr", "kind", "i", "j", F.coalesce("match.canonical_name", "match.epithet").alias("matched"), F.col("match.source").alias("source"))


@query
def recognised_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _recognised(spark, folder).select(
        "doc",
        "line_nr",
        F.col("name.text").alias("name_text"),
        F.col("name.match.canonical_name").alias("canonical_name"),
        F.col("genus.match.genus").alias("genus"),
        F.col("epithet.match.epithet").alias("epithet"),
        F.nullif(rows.synonym_list(F.col("synonyms")), F.lit("")).alias("synonyms"),
        "cultivar",
        "ipen",
        "rest",
    )


@query
def fuzzy_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return match.fuzzy_candidates(lines_of(spark, folder).select("doc", "line_nr", "raw"), ["doc", "line_nr"], "raw").select("doc", "line_nr", "option", "num_tokens", "i", "j", "index")


@query
def nearest_names(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "reference_names").groupBy(tx.name_key(F.col("canonical_name")).alias("key")).agg(F.min("ref_id").alias("ord"))
    asked = _lookups(spark, folder).select(tx.fully_clean(F.col("extracted_name")).alias("lookup"))
    return match.nearest_names(asked, "lookup", keys)


@query
def fuzzy_best_score(spark: SparkSession, folder: str) -> DataFrame:
    return _fuzzy(spark, folder, "best_score")


@query
def fuzzy_longest_name(spark: SparkSession, folder: str) -> DataFrame:
    return _fuzzy(spark, folder, "longest_name")


def _fuzzy(spark: SparkSession, folder: str, strategy: str) -> DataFrame:
    known = plan.dictionaries(source_names(spark, folder))
    found = cut_lineage(plan.recognise(lines_of(spark, folder), known))
    fuzzy = plan.add_fuzzy(found, known, match.Fuzzy(threshold=0.9, strategy=strategy))
    return fuzzy.where("name.score < 1").select("doc", "line_nr", F.col("name.text").alias("option"), F.col("name.match.canonical_name").alias("canonical_name"), F.col("name.score").alias("score"), "rest")


# ---------------------------------------------------------------- context


@query
def near_blocks(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "document_lines").groupBy(F.col("file_id").alias("doc"), "line_nr").agg(F.max_by("raw_line", "line_id").alias("raw"))
    entries = table(spark, folder, "list_entries").where("match_name IS NOT NULL").select(F.col("file_id").alias("doc"), F.col("line").alias("line_nr")).distinct()
    marked = lines.withColumn("raw", F.coalesce("raw", F.lit(""))).join(entries.withColumn("named", F.lit(True)), ["doc", "line_nr"], "left").withColumn("named", F.coalesce("named", F.lit(False)))
    return context.near_blocks(marked, "named", "raw", block_limit=100).select("doc", "line_nr")


@query
def split_codes(spark: SparkSession, folder: str) -> DataFrame:
    pre = lines_of(spark, folder).withColumn("rest", F.nullif(tx.preprocess_line(F.col("raw")), F.lit("")))
    return context.split_codes(pre, "rest", "raw")


@query
def next_values(spark: SparkSession, folder: str) -> DataFrame:
    lines = _in_context(spark, folder).withColumn("list", rows.synonym_list(F.col("synonyms")))
    return lines.select(
        "doc", "line_nr", context.next_code().alias("ipen_next"), context.next_code(("ipen", "name")).alias("ipen_before"), context.next_value("list").alias("synonyms_next"), context.next_value("cultivar").alias("cultivar_next")
    )


@query
def meta_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = _in_context(spark, folder)
    return lines.where("has_name OR has_epithet OR has_genus").select("doc", "line_nr", "meta_rest", F.array_join("meta_next", "|").alias("meta_next"))


@query
def epithet_resolution(spark: SparkSession, folder: str) -> DataFrame:
    known = plan.dictionaries(source_names(spark, folder))
    needed = [F.struct("name.text", F.struct("name.match.canonical_name", "name.match.taxon_rank").alias("match"), "name.score").alias("name")]
    needed += [F.struct(F.struct("genus.match.genus").alias("match")).alias("genus"), F.struct(F.struct("epithet.match.epithet").alias("match"), "epithet.score").alias("epithet")]
    found = cut_lineage(plan.recognise(lines_of(spark, folder), known).select("doc", "line_nr", "repeat_symbols", *needed))
    return context.resolve_epithets(found, known.canonical)


@query
def genera_scores(spark: SparkSession, folder: str) -> DataFrame:
    found = plan.recognise(lines_of(spark, folder), plan.dictionaries(source_names(spark, folder)))
    return found.where("name IS NOT NULL").select("doc", "line_nr", F.round(rows.genera_score(), 9).alias("score"))


# ---------------------------------------------------------------- legends


@query
def legend_detect(spark: SparkSession, folder: str) -> DataFrame:
    return legend.detect_symbols(_in_context(spark, folder))


@query
def legend_describe(spark: SparkSession, folder: str) -> DataFrame:
    lines = _in_context(spark, folder)
    return legend.describe_symbols(lines, legend.detect_symbols(lines))


@query
def legend_notes(spark: SparkSession, folder: str) -> DataFrame:
    lines = _in_context(spark, folder)
    notes = legend.attach_notes(lines, legend.describe_symbols(lines, legend.detect_symbols(lines)))
    return notes.select("doc", "line_nr", F.array_join("notes", "; ").alias("notes"))


# ---------------------------------------------------------------- rows


@query
def exact_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.output_rows(plan.add_notes(_in_context(spark, folder))).drop("genera_match_score")


@query
def extract_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plan.extract(lines_of(spark, folder), source_names(spark, folder))


# ---------------------------------------------------------------- sources


@query
def content_lines(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "seedlist_files").where("file_format = 'json' AND content IS NOT NULL")
    return documents.content_lines(files, "file_id", "content")


@query
def skip_existing(spark: SparkSession, folder: str) -> DataFrame:
    done = table(spark, folder, "list_entries").select("file_id").distinct()
    return table(spark, folder, "seedlist_files").join(done, "file_id", "left_anti").select("file_id", "filename")


@query
def split_on_genera(spark: SparkSession, folder: str) -> DataFrame:
    known = names.genus_dictionary(source_names(spark, folder)).select("key")
    lines = table(spark, folder, "document_lines").where("raw_line IS NOT NULL").select("line_id", F.col("raw_line").alias("raw"))
    return documents.split_on_genera(lines, "line_id", "raw", known)
