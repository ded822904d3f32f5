"""The whole extraction: lines in, one row for each recognised entry out. One lazy plan; nothing is collected."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hortulus.functions.similarity import indel_ratio
from hortulus.functions.text import cultivar, fully_clean, ipen, name_key, position_of, preprocess_line, repeat_symbols, strip, synonym_strings, tokens_of
from hortulus.operators import legend as legends
from hortulus.operators.context import following_lines, near_blocks, resolve_epithets, split_codes, trim_last
from hortulus.operators.match import Fuzzy, best_options, dictionary_of, fuzzy_candidates, key_sieve, leftmost_longest, match_fuzzy, matched_text, remaining_text
from hortulus.operators.names import canonical_dictionary, epithet_dictionary, genus_dictionary
from hortulus.operators.rows import output_rows
from hortulus.runtime import cut_lineage


@dataclass(frozen=True)
class Options:
    """What is extracted and how."""

    codes: bool = True
    field_order: tuple[str, str] = ("name", "ipen")
    fuzzy: Fuzzy | None = None
    look_ahead: int = 5
    section: frozenset[int] = field(default_factory=frozenset)


@dataclass(frozen=True)
class Dictionaries:
    """The three dictionaries, and all in one for matching."""

    canonical: DataFrame
    genera: DataFrame
    epithets: DataFrame

    @property
    def together(self) -> DataFrame:
        return dictionary_of(self.canonical, self.genera, self.epithets)

    def most_words(self) -> int:
        """Words of the longest key: what bounds the windows."""
        return self.together.agg(F.max(F.size(F.split("key", " ")))).first()[0] or 1

    @cached_property
    def bits(self) -> DataFrame:
        return key_sieve(self.together)


def dictionaries(names: DataFrame) -> Dictionaries:
    return Dictionaries(cut_lineage(canonical_dictionary(names)), cut_lineage(genus_dictionary(names)), cut_lineage(epithet_dictionary(names)))


def find_synonyms(lines: DataFrame, known: Dictionaries, most_words: int) -> DataFrame:
    """(doc, line_nr, synonyms, without): bracketed synonyms that are names, and the line (pre) without them."""
    strings = cut_lineage(lines.select("doc", "line_nr", "pre", F.posexplode(synonym_strings(F.col("pre"))).alias("k", "string")))
    hits = leftmost_longest(strings.select("doc", "line_nr", "k", "string"), ["doc", "line_nr", "k"], "string", known.together.where("kind = 'name'"), most_words, known.bits)
    found = strings.join(hits.drop("kind"), ["doc", "line_nr", "k"])
    text = matched_text(tokens_of(F.col("string")), F.col("i"), F.col("j"))
    each = found.groupBy("doc", "line_nr", "pre").agg(F.sort_array(F.collect_list(F.struct("k", text.alias("text"), "match", "string"))).alias("s"))
    without = F.aggregate("s", F.col("pre"), lambda t, x: F.replace(t, x["string"], F.lit("")))
    return each.select("doc", "line_nr", F.transform("s", lambda x: F.struct(x["text"].alias("text"), x["match"].alias("match"))).alias("synonyms"), without.alias("without"))


def recognise(lines: DataFrame, known: Dictionaries, options: Options = Options()) -> DataFrame:
    """`lines` (doc, line_nr, raw) with repeat_symbols, synonyms, genus, epithet, name, cultivar, ipen and rest."""
    most, kinds = known.most_words(), ("name", "genus", "epithet")
    columns = [c for c in lines.columns if c not in ("doc", "line_nr")]
    done = preprocess_line(F.col("raw"))
    # written once and without what is the same as raw: the lines are read for synonyms, for names and for the result
    kept = cut_lineage(lines.select("doc", "line_nr", *columns, done.alias("__done")).withColumn("__done", F.when(F.col("__done") != F.col("raw"), F.col("__done"))))
    pre = F.coalesce("__done", "raw")
    active = F.length(pre) > 0
    if options.section:
        active = active & F.col("line_nr").isin(*options.section)
    marked = pre.rlike("(?i)(sin|syn)[.:]* ")
    texts = kept.where(active).select("doc", "line_nr", pre.alias("pre"), marked.alias("marked"))
    synonyms = cut_lineage(find_synonyms(texts.where("marked"), known, most))
    changed = texts.where("marked").join(synonyms.select("doc", "line_nr", "without"), ["doc", "line_nr"], "left").select("doc", "line_nr", F.coalesce("without", "pre").alias("text"))
    whole = texts.where("NOT marked").select("doc", "line_nr", F.col("pre").alias("text"))
    hits = leftmost_longest(whole.unionByName(changed), ["doc", "line_nr"], "text", known.together, most, known.bits)
    wide = hits.groupBy("doc", "line_nr").agg(*[F.max_by(F.struct("i", "j", "match"), F.when(F.col("kind") == k, F.lit(1))).alias(f"hit_{k}") for k in kinds])
    met = kept.join(wide, ["doc", "line_nr"], "left").join(synonyms, ["doc", "line_nr"], "left")
    met = met.withColumn("pre", F.when(active, pre)).drop("__done").withColumn("text", F.coalesce("without", "pre"))
    tokens, text, hit = F.col("tokens"), F.col("text"), {k: F.col(f"hit_{k}") for k in kinds}
    met = met.withColumn("tokens", F.when(F.coalesce(*[h["i"] for h in hit.values()]).isNotNull(), tokens_of(text)))
    met = met.withColumns({f"found_{k}": F.when(h.isNotNull(), matched_text(tokens, h["i"], h["j"])) for k, h in hit.items()})
    items = {k: F.struct(F.col(f"found_{k}").alias("text"), h["match"].alias("match"), F.lit(1.0).alias("score"), position_of(F.col(f"found_{k}"), text).alias("index")) for k, h in hit.items()}
    rest = F.when(hit["name"].isNotNull(), remaining_text(tokens, hit["name"]["i"], hit["name"]["j"])).otherwise(text)
    met = met.withColumns({k: F.when(hit[k].isNotNull(), item) for k, item in items.items()} | {"repeat_symbols": repeat_symbols(F.col("pre")), "rest": rest})
    met = met.withColumn("cultivar", F.when(F.col("name").isNotNull() | F.col("epithet").isNotNull(), cultivar(F.col("rest"))))
    met = met.withColumn("rest", F.when(F.col("cultivar").isNotNull(), F.replace("rest", F.col("cultivar"), F.lit(""))).otherwise(F.col("rest")))
    if options.codes:
        met = met.withColumn("ipen", ipen(F.col("rest")))
        met = met.withColumn("rest", F.when(F.col("ipen").isNotNull(), F.replace("rest", F.col("ipen"), F.lit(""))).otherwise(F.col("rest")))
    else:
        met = met.withColumn("ipen", F.lit(None).cast("string"))
    none = F.array().cast(met.schema["synonyms"].dataType)
    empty = F.array().cast("array<string>")
    return met.select("doc", "line_nr", *columns, F.coalesce("repeat_symbols", empty).alias("repeat_symbols"), F.coalesce("synonyms", none).alias("synonyms"), *kinds, "cultivar", "ipen", "rest")


def join_split_codes(lines: DataFrame, known: Dictionaries, options: Options) -> DataFrame:
    """recognise() with codes that run over two lines: the halves are taken out and the lines concerned recognised again."""
    first = cut_lineage(recognise(lines, known, options))
    if not options.codes:
        return first
    halves = cut_lineage(split_codes(first.select("doc", "line_nr", "raw", "rest"), "rest", "raw"))
    if not halves.take(1):
        return first
    starts = halves.select("doc", "line_nr", F.col("ipen").alias("code"), "first_half")
    ends = halves.groupBy("doc", F.col("next_nr").alias("line_nr")).agg(F.max("second_half").alias("second_half"))
    columns = [c for c in lines.columns if c not in ("doc", "line_nr")]
    changed = first.select("doc", "line_nr", *columns).join(ends, ["doc", "line_nr"]).withColumn("raw", F.replace("raw", F.col("second_half"), F.lit(""))).drop("second_half")
    again = recognise(changed.select(*lines.columns), known, options)
    kept = first.join(ends.select("doc", "line_nr"), ["doc", "line_nr"], "left_anti")
    both = kept.unionByName(again).join(starts, ["doc", "line_nr"], "left")
    rest = F.when(F.col("code").isNotNull() & (F.col("first_half") != ""), F.replace("rest", F.col("first_half"), F.lit(""))).otherwise(F.col("rest"))
    return both.withColumns({"rest": rest, "ipen": F.coalesce("ipen", "code")}).drop("code", "first_half")


def add_fuzzy(lines: DataFrame, known: Dictionaries, settings: Fuzzy) -> DataFrame:
    """Names for lines without one (or with a genus only), from the nearest names of their spans."""
    named = lines.withColumn("has_name", F.col("name").isNotNull())
    looked = near_blocks(named, "has_name", "raw", settings.max_gap, settings.line_block_limit) if settings.near_blocks else named
    looked = looked.where(F.col("name").isNull() | (F.col("name.match.taxon_rank") == "genus"))
    candidates = cut_lineage(fuzzy_candidates(looked.select("doc", "line_nr", "raw"), ["doc", "line_nr"], "raw", settings))
    found = match_fuzzy(candidates, "option", known.canonical, settings.threshold).where(F.col("score") >= settings.threshold)
    order = ("canonical_name", "genus", "epithet", "infraspecific_epithet", "authorship", "taxon_rank", "source", "authorships")
    found = found.select("lookup", "score", F.struct(*order).alias("match"))
    # options of a document that differ in case only share the match of the last in order
    options = candidates.select("doc", F.col("option").alias("lookup"), F.lower("option").alias("low")).distinct().join(found, "lookup")
    shared = options.groupBy("doc", "low").agg(F.max_by(F.struct("score", "match"), "lookup").alias("m"))
    matched = candidates.withColumn("low", F.lower("option")).join(shared, ["doc", "low"]).select("doc", "line_nr", "option", "num_tokens", "i", "j", "index", "m.score", "m.match")
    best = best_options(matched, ["doc", "line_nr"], settings.strategy)
    name = F.struct(F.col("option").alias("text"), F.col("match"), F.col("score"), F.col("index"))
    taken = best.select("doc", "line_nr", name.alias("fuzzy"), F.split("option", " ").alias("bits"))
    rest = F.aggregate("bits", F.coalesce("rest", F.lit("")), lambda t, b: strip(F.replace(t, b, F.lit(""))))
    both = lines.join(taken, ["doc", "line_nr"], "left")
    return both.withColumns({"name": F.coalesce("fuzzy", "name"), "rest": F.when(F.col("fuzzy").isNotNull(), rest).otherwise(F.col("rest"))}).drop("fuzzy", "bits")


def add_resolved(lines: DataFrame, known: Dictionaries) -> DataFrame:
    """Names for isolated epithets."""
    solved = resolve_epithets(lines, known.canonical)
    fields = ("canonical_name", "genus", "epithet", "infraspecific_epithet", "authorship", "taxon_rank", "source", "authorships")
    found = solved.join(known.canonical, "key").select("doc", "line_nr", F.col("text").alias("solved"), F.struct(*fields).alias("m"))
    both = lines.join(found, ["doc", "line_nr"], "left")
    score = indel_ratio(name_key(F.col("solved")), F.lower(fully_clean(F.col("m.canonical_name"))))
    name = F.when(F.col("m").isNotNull(), F.struct(F.col("solved").alias("text"), F.col("m").alias("match"), score.alias("score"), F.lit(-1).alias("index")))
    epithet = F.col("epithet.match.epithet")
    rest = F.when(F.col("m").isNotNull(), F.regexp_replace(F.col("rest"), F.concat(F.lit("(?i)\\Q"), epithet, F.lit("\\E")), F.lit(""))).otherwise(F.col("rest"))
    return both.withColumns({"rest": rest, "name": F.coalesce(name, "name")}).drop("solved", "m")


def with_context(lines: DataFrame, options: Options = Options()) -> DataFrame:
    """What lines are, the rest of their text, and the lines behind them."""
    seen = lines.withColumns(
        {
            "has_name": F.col("name").isNotNull(),
            "has_epithet": F.col("epithet").isNotNull(),
            "has_genus": F.col("genus").isNotNull(),
            "has_synonyms": F.size("synonyms") > 0,
        }
    )
    entry = F.col("has_name") | F.col("has_epithet") | F.col("has_genus")
    at = F.instr(F.col("rest"), F.col("epithet.text"))
    without = F.concat(F.substring(F.col("rest"), F.lit(1), at - 1), F.substring(F.col("rest"), at + F.length("epithet.text"), F.length("rest")))
    cleaned = F.when(F.col("has_epithet") & ~F.col("has_name") & (at > 0), without).otherwise(F.col("rest"))
    seen = seen.withColumn("rest", cleaned).withColumn("meta_rest", F.when(entry & (F.length("rest") > 0), strip(F.col("rest"))))
    seen = seen.withColumn("has_any", entry | F.col("cultivar").isNotNull() | F.col("has_synonyms"))
    return trim_last(following_lines(seen, options.look_ahead))


def add_notes(lines: DataFrame) -> DataFrame:
    symbols = legends.detect_symbols(lines)
    notes = legends.attach_notes(lines, legends.describe_symbols(lines, symbols))
    return lines.join(notes, ["doc", "line_nr"], "left")


def extract(lines: DataFrame, names: DataFrame | Dictionaries, options: Options = Options()) -> DataFrame:
    """The output rows of `lines` (doc, line_nr, raw, filename, garden_code, year), with `names` as from with_priority(), or ready-made
    dictionaries."""
    known = names if isinstance(names, Dictionaries) else dictionaries(names)
    found = join_split_codes(lines, known, options)
    if options.fuzzy is not None:
        found = add_fuzzy(cut_lineage(found), known, options.fuzzy)
    resolved = cut_lineage(add_resolved(found, known))
    return output_rows(add_notes(cut_lineage(with_context(resolved, options))), options.field_order)
