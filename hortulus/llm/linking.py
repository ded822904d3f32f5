"""Mapping freely written values to the closest entry of a canonical list.

The cosine is a soft one (Cohen, Ravikumar and Fienberg 2003): words are compared by the weighted cosine of their character
trigrams, names by the weighted sum over their words. So all comparing is done once for each distinct word, not for each value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hortulus.llm.lookalike import CYRILLIC, CYRILLIC_AS_LATIN, GREEK, GREEK_AS_LATIN, INVISIBLE
from hortulus.runtime import cut_lineage, spread

# Rank abbreviations and the form in which the list writes them.
RANKS = {"f": "f", "fo": "f", "forma": "f", "form": "f", "var": "var", "variet": "var", "varietas": "var", "v": "var", "subsp": "subsp", "ssp": "subsp", "subspec": "subsp", "subspecies": "subsp"}
# Words that are no part of a name.
NO_NAME = ("no", "nr", "cf", "aff", "hort", "cult", "ex", "sp", "spec", "spp", "div", "indet", "hybr", "et", "x", "×")
#: Broadcast a table of so many rows at most; a larger one is joined by shuffle.
MOST_BROADCAST = 500_000
#: The least cosine of a word, the least score of an entry, and how far ahead of every other it must be.
LEAST, THRESHOLD, MARGIN = 0.1, 0.25, 0.002


def plain_value(value: Column) -> Column:
    """One line of lower-case Latin words: look-alikes unified, breaks inside words mended, digits that stand for letters
    replaced, other punctuation as blanks. Null gives ''."""
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    narrow = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
    text = F.translate(F.coalesce(value.cast("string"), F.lit("")), wide + CYRILLIC + GREEK, narrow + CYRILLIC_AS_LATIN + GREEK_AS_LATIN)
    text = F.lower(F.regexp_replace(text, f"[{INVISIBLE}]", ""))
    text = F.regexp_replace(F.regexp_replace(text, "ﬁ", "fi"), "ﬂ", "fl")
    text = F.regexp_replace(text, "(?<=\\p{L})[-¬=‐‑–]\\s*(?=\\p{L})", "")
    for digit, letter in (("0", "o"), ("1", "l"), ("5", "s")):
        text = F.regexp_replace(text, f"(?<=\\p{{L}}){digit}|{digit}(?=[\\p{{L}}015])", letter)
    return F.trim(F.regexp_replace(text, "[^\\p{L}\\p{M}×]+", " "))


def grams(word: str, n: int = 3) -> Column:
    """The distinct character n-grams of a word marked at both ends."""
    marked = F.concat(F.lit("^"), F.col(word), F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.length(word) + 3 - n, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(marked, i, F.lit(n))))


def _parts(text: Column) -> tuple[Column, Column]:
    """(words without rank and other words, rank as the list writes it or '')."""
    tokens = F.split(text, " ")
    words = F.filter(tokens, lambda t: (F.length(t) > 0) & ~t.isin(*RANKS, *NO_NAME))
    rank = F.coalesce(_rank_of(F.get(F.filter(F.slice(tokens, F.lit(2), F.size(tokens)), lambda t: t.isin(*RANKS)), F.lit(0))), F.lit(""))
    return words, rank


def _rank_of(token: Column) -> Column:
    out = F.lit("")
    for written, rank in RANKS.items():
        out = F.when(token == written, rank).otherwise(out)
    return out


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def list_entries(reference: DataFrame) -> DataFrame:
    """(ref_id, words, rank) of (ref_id, canonical_name): the words of each entry, and the same with the first two run together."""
    base = reference.where("ref_id IS NOT NULL AND canonical_name IS NOT NULL").select(F.col("ref_id").cast("long").alias("ref_id"), plain_value(F.col("canonical_name")).alias("text"))
    words, rank = _parts(F.col("text"))
    each = base.select("ref_id", words.alias("words"), rank.alias("rank")).where(F.size("words") > 0)
    joined = F.concat(F.array(F.concat(F.get("words", F.lit(0)), F.get("words", F.lit(1)))), F.slice("words", F.lit(3), F.size("words")))
    both = each.select("ref_id", "rank", F.col("words"), F.lit(False).alias("joined")).unionByName(each.where(F.size("words") > 1).select("ref_id", "rank", joined.alias("words"), F.lit(True).alias("joined")))
    return both.groupBy("words", "rank").agg(F.min("ref_id").alias("ref_id"), F.min("joined").alias("joined"))


def _vectors(words: DataFrame, idf: DataFrame, unseen: Column) -> DataFrame:
    """(word, gram, idf, square, total, before) of (word): the square of each gram's weight, that of all grams of the word and that of the rarer ones."""
    long = words.select("word", F.explode(grams("word")).alias("gram")).join(_sized(idf), "gram", "left").withColumn("idf", F.coalesce("idf", unseen))
    long = long.withColumn("square", F.col("idf") * F.col("idf"))
    order = Window.partitionBy("word").orderBy(F.col("idf").desc(), "gram")
    until = F.sum("square").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return long.withColumn("before", until - F.col("square")).withColumn("total", F.sum("square").over(Window.partitionBy("word")))


def alike_words(words: DataFrame, listed: DataFrame, least: float, tolerance: float) -> DataFrame:
    """(word, ref_word, cosine) of two tables (word): all pairs of a cosine of `least` or more that are within `tolerance` edits a letter
    (two at least) of each other.

    Both sides keep the grams in one order, rarest first. If the cosine of two words reaches `least`, the first gram that they share is,
    on either side, among those before which at least `least` squared of the vector's square is left (else all that they share would be too
    short for it): only these are indexed and looked up, and no pair is lost.
    """
    n = listed.agg(F.count(F.lit(1)).cast("double").alias("n")).first()[0]
    df = listed.select(F.explode(grams("word")).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    idf = cut_lineage(df.select("gram", F.log1p(F.lit(n) / F.col("df")).alias("idf")))
    # a rounding error must not lose a pair
    rare = F.col("total") - F.col("before") >= F.lit(least * least - 1e-9) * F.col("total")
    unseen = F.log1p(F.lit(2.0 * n))  # as if it stood in half a word
    sizes = listed.agg(F.max(F.length("word"))).first()[0] or 0
    longest = max(sizes + 2, int(sizes * (1 + tolerance)) + 1)  # a longer word is within the edits of none
    asked = words.where(F.length("word") <= longest)
    probes = _vectors(spread(asked, "word"), idf, unseen).where(rare & (F.col("idf") < unseen)).select("word", "gram")
    postings = _vectors(listed, idf, unseen).where(rare).select(F.col("word").alias("ref_word"), "gram")
    edits = F.greatest(F.lit(2), F.floor(F.length("ref_word") * F.lit(tolerance))).cast("int")
    met = probes.join(_sized(postings), "gram").where(F.abs(F.length("word") - F.length("ref_word")) <= edits).select("word", "ref_word").distinct()
    near = cut_lineage(met.where(F.levenshtein("word", "ref_word") <= edits))
    # the whole cosine of the few that are left
    weights = lambda side, name: _vectors(near.select(F.col(side).alias("word")).distinct(), idf, unseen).groupBy("word", "total").agg(F.map_from_entries(F.collect_list(F.struct("gram", "square"))).alias(name)).select(F.col("word").alias(side), name, F.col("total").alias(f"{name}_total"))
    both = near.join(weights("word", "a"), "word").join(weights("ref_word", "b"), "ref_word")
    dot = F.aggregate(F.map_keys("a"), F.lit(0.0), lambda s, k: s + F.when(F.map_contains_key("b", k), F.element_at("a", k)).otherwise(0.0))
    return both.select("word", "ref_word", F.round(dot / F.sqrt(F.col("a_total") * F.col("b_total")), 6).alias("cosine")).where(F.col("cosine") >= least)


def link_values(values: DataFrame, value: str, reference: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN, least_cosine: float = LEAST, tolerance: float = 0.25, max_list: int = 2_000_000) -> DataFrame:
    """(value, ref_id) for each distinct non-empty value: the entry it means, or -1.

    Values are deduplicated and normalised. Their words are looked up in an inverted index of the character trigrams of the words of the
    list, weighted by inverse frequency, and scored by cosine; a word that stands in the list means itself alone. Entries whose every
    word has a word of the value (in any order) of `least_cosine` and within `tolerance` edits a letter (two at least), and whose rank is
    the value's, are candidates; their score is the mean of their words' cosines weighted by the squared inverse frequency of the words. The best
    one is accepted if it reaches `threshold` and is ahead of every other by `margin`. Further words of the value don't count against it. A
    genus written as one letter stands for each genus of that initial, and a genus and epithet run together for both. Null and ''
    have no row; a value without words, and every value against an empty list, gives -1. Repeated list entries (same words) are one,
    the smallest id. A list of more than `max_list` rows is refused.
    """
    listed = reference.count()
    if listed > max_list:
        raise ValueError(f"the list has {listed} entries; {max_list} are the most")
    entries = cut_lineage(list_entries(reference))
    distinct = values.select(F.col(f"`{value}`").cast("string").alias("value")).where("value IS NOT NULL AND value <> ''").distinct()
    words, rank = _parts(F.col("text"))
    forms = cut_lineage(distinct.select("value", plain_value(F.col("value")).alias("text")))
    by_text = forms.select("text").distinct().select("text", F.array_distinct(words).alias("words"), rank.alias("rank")).where(F.size("words") > 0)
    by_text = cut_lineage(spread(by_text, "text"))

    # words: which of the list each one means
    used = entries.select(F.explode("words").alias("word"), "joined")
    listed_words = cut_lineage(used.groupBy("word").agg(F.min("joined").alias("joined"), F.count(F.lit(1)).alias("n")))
    own = listed_words.where("NOT joined").select("word")
    asked = by_text.select(F.explode("words").alias("word")).distinct()
    unknown = asked.join(_sized(own), "word", "left_anti")
    exact = asked.join(_sized(listed_words.select("word")), "word", "left_semi").select("word", F.col("word").alias("ref_word"), F.lit(1.0).alias("cosine"))
    # a word equal to two words run together may still be a misspelt one
    alike = alike_words(unknown, listed_words.select("word"), least_cosine, tolerance).where("word <> ref_word")
    meant = cut_lineage(exact.unionByName(alike))

    # entries: found by their rarest word (but an abbreviated genus), which the value must hold as all others
    total = entries.count()
    weight = listed_words.select("word", F.pow(F.log1p(F.lit(float(total)) / F.col("n")), 2).alias("weight"))
    positions = entries.select("ref_id", "rank", "words", F.posexplode("words").alias("i", "word")).join(_sized(weight), "word")
    with_weights = positions.groupBy("ref_id", "rank", "words").agg(
        F.sort_array(F.collect_list(F.struct("i", "word", "weight"))).alias("parts"), F.max_by("word", F.struct(F.when((F.col("i") > 0) | (F.size("words") == 1), F.col("weight")).otherwise(-1.0).alias("w"), "word")).alias("anchor")
    )
    with_weights = cut_lineage(with_weights.select("ref_id", F.col("rank").alias("ref_rank"), "parts", "anchor"))
    by_word = by_text.select("text", "rank", "words", F.explode("words").alias("word")).join(_sized(meant), "word").groupBy("text", "rank", "words", "ref_word").agg(F.max("cosine").alias("cosine"))
    known = by_word.groupBy("text", "rank", "words").agg(F.map_from_entries(F.collect_list(F.struct("ref_word", "cosine"))).alias("known"))
    anchored = known.select("text", "rank", "words", "known", F.explode(F.map_keys("known")).alias("anchor")).join(_sized(with_weights), "anchor").where("rank = ref_rank")
    first = F.get("parts", F.lit(0))["word"]
    initial = (F.size("parts") > 1) & F.exists("words", lambda t: (F.length(t) == 1) & (t == F.substring(first, 1, 1)))
    anchored = anchored.withColumn("initial", initial)
    cosine = lambda p: F.when((p["i"] == 0) & F.col("initial"), F.lit(1.0)).otherwise(F.element_at("known", p["word"]))
    held = anchored.where(F.forall("parts", lambda p: cosine(p).isNotNull()))
    score = F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["weight"] * cosine(p)) / F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["weight"])
    scored = held.select("text", "ref_id", F.round(score, 6).alias("score")).where(F.col("score") >= threshold).groupBy("text", "ref_id").agg(F.max("score").alias("score"))

    place = F.row_number().over(Window.partitionBy("text").orderBy(F.col("score").desc(), "ref_id"))
    best = scored.withColumn("place", place).where("place <= 2").groupBy("text").agg(
        F.max(F.when(F.col("place") == 1, F.col("ref_id"))).alias("ref_id"), F.max(F.when(F.col("place") == 1, F.col("score"))).alias("first"), F.max(F.when(F.col("place") == 2, F.col("score"))).alias("second")
    )
    accepted = best.where(F.col("first") - F.coalesce("second", F.lit(-1.0)) >= margin).select("text", "ref_id")
    return forms.join(accepted, "text", "left").select("value", F.coalesce("ref_id", F.lit(-1).cast("long")).alias("ref_id"))


def link_rows(rows: DataFrame, ident: str, value: str, reference: DataFrame, **options) -> DataFrame:
    """(ident, ref_id) for each row with a value that is neither null nor empty; repeated rows each have theirs."""
    wanted = rows.where(F.col(f"`{value}`").isNotNull() & (F.col(f"`{value}`") != "")).select(F.col(f"`{ident}`").alias("__id"), F.col(f"`{value}`").cast("string").alias("value"))
    linked = link_values(wanted, "value", reference, **options)
    return wanted.join(linked, "value", "left").select(F.col("__id").alias(ident), F.coalesce("ref_id", F.lit(-1).cast("long")).alias("ref_id"))
