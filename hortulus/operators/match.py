"""Recognising names in lines: exact lookups, leftmost-longest matching, nearest names by edit distance."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hortulus.functions.similarity import indel_ratio
from hortulus.functions.text import DROPPED, clean_name, fully_clean, name_key, position_of, tokens_of, trim_outer
from hortulus.runtime import cut_lineage, spread

#: A dictionary of so many keys at most (some 450 bytes each with its match, several times that in the driver) is broadcast; a larger one is
#: joined by shuffle.
MOST_BROADCAST = 60_000
#: The same for pieces of names and other rows of a few short columns.
MOST_PIECES = 250_000
#: Pairs of rows that are formed directly at most.
MOST_PAIRS = 2_000_000
#: Bits of a sieve for each entry, and 64-bit words of a sieve at most (16 MB).
SIEVE_BITS, SIEVE_WORDS = 16, 1 << 21


def sized(df: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """With a broadcast hint if it is small enough."""
    return F.broadcast(df) if df.count() <= most else df


def starts_lower(text: Column) -> Column:
    first = F.substring(text, 1, 1)
    return (F.lower(first) == first) & (F.upper(first) != first)


def match_exact(lookups: DataFrame, lookup: str, dictionary: DataFrame, kind: str = "name") -> DataFrame:
    """The lookups that a dictionary has, with its columns. A genus never matches what begins with a small letter."""
    keyed = lookups.withColumn("key", name_key(F.col(lookup))).where("key <> ''")
    found = keyed.join(dictionary, "key")
    if kind == "genus":
        return found.where(~starts_lower(F.col(lookup)))
    return found if kind == "epithet" else found.where(~((F.col("taxon_rank") == "genus") & starts_lower(F.col(lookup))))


def sieve(entries: DataFrame) -> DataFrame:
    """One row (bits: array of 64-bit words): a Bloom filter of the strings `entry`. What may_be_in() refuses is none of them; of other strings
    it lets a few in a hundred pass, more if the sieve is at its largest. Two megabytes a million entries, whatever belongs to them."""
    words, wanted = 1 << 10, entries.count() * SIEVE_BITS
    while words < SIEVE_WORDS and words * 64 < wanted:
        words <<= 1
    place, mask = _sieve_place(F.col("entry"), F.lit(words))
    held = entries.select(place.alias("place"), mask.alias("mask")).groupBy("place").agg(F.expr("bit_or(mask)").alias("mask"))
    every = entries.sparkSession.range(words).select(F.col("id").alias("place")).join(held, "place", "left").select("place", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    ordered = F.sort_array(F.collect_list(F.struct("place", "mask")))
    return cut_lineage(every.agg(F.transform(ordered, lambda x: x["mask"]).alias("bits")))


def _sieve_place(text: Column, words: Column) -> tuple[Column, Column]:
    """The word of a sieve that a string belongs to, and the three bits that it sets there."""
    h = F.xxhash64(text)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63).cast("long")).cast("int")) for at in (32, 40, 48)]
    return h.bitwiseAND(words.cast("long") - 1), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def may_be_in(text: Column, bits: Column) -> Column:
    place, mask = _sieve_place(text, F.size(bits))
    return F.get(bits, place.cast("int")).bitwiseAND(mask) == mask


def key_sieve(dictionary: DataFrame) -> DataFrame:
    """The sieve of the keys, and of their first words with a blank behind."""
    keys = dictionary.select("key").distinct()
    first = keys.select(F.concat(F.substring_index("key", " ", 1), F.lit(" ")).alias("entry")).distinct()
    return sieve(cut_lineage(keys.select(F.col("key").alias("entry")).unionByName(first)))


def _token_key(token: Column) -> Column:
    """name_key() of a string without white space."""
    return F.when(token.isin(*DROPPED), F.lit("")).otherwise(F.lower(clean_name(token)))


def windows(texts: DataFrame, ids: list[str], text: str, most_words: int, bits: DataFrame | None = None) -> DataFrame:
    """The windows of tokens (ids; i, j from 0, j exclusive; key; capital) that can match a key of `most_words` words.

    The key of a window is that of its tokens that are not cleaned to nothing, so for each start it is enough to take the next
    1..most_words of these, each up to the token before the one after: the longest window with that key. Tokens are cleaned
    once; each explode keeps the expressions before it from being evaluated again for every window. With `bits` (of key_sieve())
    only windows whose first word and whose key pass the sieve are made; nothing is shuffled.
    """
    tokens = texts.select(*ids, tokens_of(F.col(text)).alias("__t"))
    cleaned = F.transform("__t", lambda t, i: F.struct(i.alias("i"), _token_key(t).alias("c"), (~starts_lower(t)).alias("capital")))
    line = tokens.select(*ids, F.size("__t").alias("__n"), cleaned.alias("all"))
    solid = line.select(*ids, "__n", "all", F.filter("all", lambda s: s["c"] != "").alias("solid"))
    starts = solid.select(*ids, "__n", "solid", F.explode_outer("all").alias("s")).select(*ids, "__n", "solid", F.col("s.i").alias("i"), F.col("s.capital").alias("capital"))
    behind = F.slice(F.filter("solid", lambda s: s["i"] >= F.col("i")), 1, most_words + 1)
    ahead = starts.select(*ids, "__n", "i", "capital", behind.alias("behind"))
    if bits is not None:
        word = F.concat(F.substring_index(F.get("behind", F.lit(0))["c"], " ", 1), F.lit(" "))
        ahead = ahead.select("*", word.alias("__word")).join(F.broadcast(bits), may_be_in(F.col("__word"), F.col("bits"))).drop("bits", "__word")
    sizes = F.when(F.size("behind") > 0, F.sequence(F.lit(1), F.least(F.size("behind"), F.lit(most_words))))
    made = ahead.select(*ids, "__n", "i", "capital", "behind", F.explode_outer(sizes).alias("m"))
    made = made.select(
        *ids, "i", F.coalesce(F.get("behind", F.col("m"))["i"], F.col("__n")).alias("j"), F.array_join(F.transform(F.slice("behind", F.lit(1), F.col("m")), lambda s: s["c"]), " ").alias("key"), "capital"
    )
    return made.where("key <> ''") if bits is None else made.join(F.broadcast(bits), may_be_in(F.col("key"), F.col("bits"))).drop("bits")


def leftmost_longest(texts: DataFrame, ids: list[str], text: str, dictionary: DataFrame, most_words: int, bits: DataFrame | None = None) -> DataFrame:
    """For each text and kind of name the match of the leftmost, then longest window: ids, kind, i, j, match.

    `dictionary` has (key, kind, genus_rank, match): all kinds of names in one, so that the windows are made and joined once.
    A match of genus rank needs a capital at the window's start, except for epithets. Only windows that pass the sieve `bits`
    meet the keys, and only the windows that are kept meet the matches.
    """
    made = windows(texts, ids, text, most_words, key_sieve(dictionary) if bits is None else bits)
    hits = made.join(sized(dictionary.select("key", "kind", "genus_rank"), MOST_PIECES), "key").where("kind = 'epithet' OR capital OR NOT genus_rank")
    first = hits.groupBy(*ids, "kind").agg(F.min_by(F.struct("i", "j", "key"), F.struct("i", -F.col("j"))).alias("hit")).select(*ids, "kind", "hit.*")
    return first.join(sized(dictionary.select("key", "kind", "match")), ["key", "kind"]).select(*ids, "kind", "i", "j", "match")


def matched_text(tokens: Column, i: Column, j: Column) -> Column:
    """The window without outer characters that are no letters."""
    return trim_outer(F.array_join(F.slice(tokens, i + 1, j - i), " "))


def remaining_text(tokens: Column, i: Column, j: Column) -> Column:
    """The line without the matched text; what was trimmed from the window stays."""
    window = F.array_join(F.slice(tokens, i + 1, j - i), " ")
    inner = trim_outer(window)
    at = F.instr(window, inner)
    pieces = F.array(F.substring(window, F.lit(1), at - 1), F.substring(window, at + F.length(inner), F.length(window)))
    kept = F.concat(F.slice(tokens, F.lit(1), i), F.filter(pieces, lambda p: p != ""), F.slice(tokens, j + 1, F.size(tokens)))
    return F.array_join(kept, " ")


def dictionary_of(canonical: DataFrame, genera: DataFrame, epithets: DataFrame) -> DataFrame:
    """(key, kind, genus_rank, match) of the three dictionaries."""
    fields = ("canonical_name", "genus", "epithet", "infraspecific_epithet", "authorship", "taxon_rank", "source")
    null = F.lit(None).cast("string")
    authors = F.col("authorships")
    none = F.array().cast("array<struct<authorship:string,source:string>>")
    whole = F.struct(*[F.col(f).alias(f) for f in fields], authors.alias("authorships"))
    genus = F.struct(*[(null if f in ("epithet", "infraspecific_epithet") else F.col(f)).alias(f) for f in fields], none.alias("authorships"))
    part = F.struct(
        *[(F.lit("epithet") if f == "taxon_rank" else F.col(f) if f in ("epithet", "infraspecific_epithet", "source") else null).alias(f) for f in fields], none.alias("authorships")
    )
    return (
        canonical.select("key", F.lit("name").alias("kind"), (F.col("taxon_rank") == "genus").alias("genus_rank"), whole.alias("match"))
        .unionByName(genera.select("key", F.lit("genus").alias("kind"), F.lit(True).alias("genus_rank"), genus.alias("match")))
        .unionByName(epithets.select("key", F.lit("epithet").alias("kind"), F.lit(False).alias("genus_rank"), part.alias("match")))
    )


# ---------------------------------------------------------------- fuzzy


@dataclass(frozen=True)
class Fuzzy:
    """Settings of fuzzy matching."""

    threshold: float = 0.9
    strategy: str = "best_score"
    near_blocks: bool = False
    min_tokens: int = 2
    max_tokens: int = 8
    min_token_length: int = 3
    large_token_length: int = 15
    line_block_limit: int = 1000
    max_gap: int = 10

    def __post_init__(self) -> None:
        if not 0 < self.threshold <= 1:
            raise ValueError("the threshold must be above 0 and at most 1")
        if self.strategy not in ("best_score", "longest_name"):
            raise ValueError(f"unknown strategy {self.strategy}")


def fuzzy_candidates(lines: DataFrame, ids: list[str], raw: str, settings: Fuzzy = Fuzzy()) -> DataFrame:
    """(ids, option, num_tokens, i, j, index): spans of the cleaned tokens of each line. A start yields spans only if no more than
    `max_tokens` tokens are left behind it; a line of too few tokens yields its long ones."""
    cleaned = F.filter(F.transform(tokens_of(F.col(raw)), fully_clean), lambda t: F.length(t) >= settings.min_token_length)
    made = lines.select(*ids, F.col(raw).alias("__raw"), cleaned.alias("t"))
    n = F.size("t")
    spans = F.flatten(
        F.transform(
            F.filter(F.sequence(F.greatest(n - settings.max_tokens, F.lit(0)), F.greatest(n, F.lit(0))), lambda i: n - i >= settings.min_tokens),
            lambda i: F.transform(
                F.sequence(i + settings.min_tokens, n),
                lambda j: F.struct(F.array_join(F.slice("t", i + 1, j - i), " ").alias("option"), (j - i).alias("num_tokens"), i.alias("i"), j.alias("j")),
            ),
        )
    )
    long = F.transform(
        F.filter(F.transform(F.col("t"), lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda s: F.length(s["t"]) >= settings.large_token_length),
        lambda s: F.struct(s["t"].alias("option"), F.lit(1).alias("num_tokens"), s["i"].alias("i"), (s["i"] + 1).alias("j")),
    )
    chosen = F.when(n >= settings.min_tokens, spans).otherwise(long)
    out = made.select(*ids, "__raw", F.inline(chosen))
    return out.select(*ids, "option", "num_tokens", "i", "j", position_of(F.lower("option"), F.lower("__raw")).alias("index"))


#: The longest piece of a name that is indexed.
LONGEST_PIECE = 6
#: A block of so many keys is compared with a lookup at once where no piece tells them apart.
BLOCK = 4096
#: So many blocks at most (some 30 MB) are broadcast.
BROADCAST_BLOCKS = 64


def _lead(text: str) -> Column:
    """1 if a text begins with a capital: no key has one, so it takes an edit by itself."""
    first = F.substring(text, 1, 1)
    return (F.lower(first) != first).cast("int")


def within(asked: DataFrame, keys: DataFrame, text: str, capital: int = 1) -> tuple[DataFrame, DataFrame]:
    """(pairs, rest): the rows of `keys` that may be within `budget` edits of each row of `asked` (lookup, budget), and the rows of `asked`
    that are too short for their budget.

    `budget` edits spoil as many of budget + 1 pieces of a lookup at most, so one of them stands unchanged in the text, no more than
    `budget` places away: an equi-join on pieces finds every such pair. An initial capital takes `capital` edits by itself (keys are in
    lower case) and leaves fewer for the rest.
    """
    lead = _lead("lookup")
    left = F.col("budget") - lead * F.lit(capital)
    piece = F.least(F.floor((F.length("lookup") - lead) / (left + 1)), F.lit(LONGEST_PIECE)).cast("int")
    step = F.floor((F.length("lookup") - lead) / (left + 1)).cast("int")
    cut = asked.withColumns({"__left": left, "__size": piece, "__step": step, "__lead": lead})
    fits = cut.where("__left >= 0 AND __size > 0")
    rest = cut.where("__left >= 0 AND __size <= 0").select(*asked.columns)
    probes = fits.withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__left")))).withColumn("__at", F.col("__lead") + F.col("__k") * F.col("__step") + 1)
    probes = probes.select(*asked.columns, "__at", F.expr("substring(lookup, __at, __size)").alias("__piece"))
    used = keys.withColumn("__size", F.explode(F.sequence(F.lit(1), F.lit(LONGEST_PIECE)))).where(F.length(text) >= F.col("__size"))
    places = used.withColumn("__place", F.explode(F.sequence(F.lit(1), F.length(text) - F.col("__size") + 1))).withColumn("__piece", F.expr(f"substring({text}, __place, __size)"))
    sizes = fits.select("__size").distinct()  # LONGEST_PIECE rows at most
    index = places.join(F.broadcast(sizes), "__size", "left_semi").select(*keys.columns, "__place", "__piece")
    met = probes.join(sized(index, MOST_PIECES), "__piece").where((F.abs(F.col("__at") - F.col("__place")) <= F.col("budget")) & (F.abs(F.length("lookup") - F.length(text)) <= F.col("budget")))
    return met.select(*asked.columns, *keys.columns).distinct(), rest


def _all_keys(asked: DataFrame, keys: DataFrame) -> DataFrame:
    """(lookup, b): the nearest key of each lookup, by comparing with all: keys are cut into blocks of a bounded size that lookups meet one by
    one, and only the nearest of a block is put out."""
    blocks = max(1, -(-keys.count() // BLOCK))
    packed = keys.withColumn("__block", F.pmod(F.xxhash64("key"), F.lit(blocks))).groupBy("__block").agg(F.collect_list(F.struct("key", "ord")).alias("__keys"))
    each = asked.select("lookup", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("__block"))
    # few blocks are taken to the lookups; many are met by shuffle
    each = each.join(F.broadcast(packed) if blocks <= BROADCAST_BLOCKS else packed, "__block")
    nearest = F.array_min(F.transform("__keys", lambda k: F.struct(F.levenshtein(F.col("lookup"), k["key"]).alias("distance"), k["ord"].alias("ord"), k["key"].alias("key"))))
    return each.select("lookup", nearest.alias("b")).groupBy("lookup").agg(F.min("b").alias("b"))


def nearest_names(lookups: DataFrame, lookup: str, keys: DataFrame, bands: tuple[int, ...] = (3, 6), least_piece: int = 3) -> DataFrame:
    """(lookup, key, distance): for each distinct lookup the nearest key by edit distance, of equal ones that of the smallest `ord`.

    Exact, in bands of growing distance: within() finds all keys in the band, and lookups that have one are answered. A lookup takes part
    as far as its pieces have `least_piece` letters (shorter ones tell no names apart). What is still open has no key within about a third
    of its length: no name is meant, and nothing but a comparison with all keys gives the nearest; it meets them block by block, and one
    row leaves each block. Null and empty lookups have no row; no keys give no rows. `keys` has (key, ord).
    """
    open_ = cut_lineage(spread(lookups.select(F.col(lookup).alias("lookup")).where("lookup IS NOT NULL AND lookup <> ''").distinct(), "lookup"))
    keys = cut_lineage(keys.select("key", "ord"))
    most = F.floor((F.length("lookup") - _lead("lookup")) / least_piece).cast("int") - 1 + _lead("lookup")
    found = []
    for band in bands:
        near, _ = within(open_.withColumn("budget", F.least(F.lit(band), most)), keys, "key")
        near = near.withColumn("distance", F.levenshtein("lookup", "key")).where("distance <= budget")
        best = cut_lineage(near.groupBy("lookup").agg(F.min(F.struct("distance", "ord", "key")).alias("b")))
        found.append(best)
        open_ = cut_lineage(spread(open_.join(best.select("lookup"), "lookup", "left_anti"), "lookup"))
    found.append(_all_keys(open_, keys))
    return reduce(DataFrame.unionByName, found).select("lookup", "b.key", "b.distance")


def python_round(value: Column, digits: int = 2) -> Column:
    """As Python rounds: by the exact binary value, half to even. The decimal halves are not binary numbers (but for quarters), so the one
    they stand for is a little more or less: 0.925 is more, 0.955 less."""
    return F.pandas_udf(lambda v: v.map(lambda x: round(x, digits), na_action="ignore"), "double")(value)


def match_fuzzy(lookups: DataFrame, lookup: str, canonical: DataFrame, cutoff: float | None = None, epithets: DataFrame | None = None) -> DataFrame:
    """(lookup, score, and the columns of the dictionary): the nearest canonical name of each lookup, compared as it is written
    with the keys in lower case, of equally near ones the first in load order, rescored by indel ratio against the whole name in lower case.

    A nearest genus is no match, nor is a nearest epithet of `epithets` (key) that is no canonical name: they stand behind the names
    in order. With a cutoff only names that can reach it are looked for, and then whether another is nearer.
    """
    asked = lookups.select(F.col(lookup).alias("lookup")).where("lookup IS NOT NULL AND lookup <> ''").distinct()
    keys = canonical.select("key", F.struct(F.lit(0).alias("kind"), F.col("prio").alias("prio"), F.col("ord").alias("ord")).alias("ord"))
    if epithets is not None:
        more = epithets.select("key").join(canonical.select("key"), "key", "left_anti")
        keys = keys.unionByName(more.select("key", F.struct(F.lit(1).alias("kind"), F.lit(0).alias("prio"), F.xxhash64("key").alias("ord")).alias("ord")))
    if not cutoff:
        found = nearest_names(asked, "lookup", keys).select("lookup", "key")
        scored = found.join(canonical, "key").where("taxon_rank <> 'genus'").withColumn("score", indel_ratio(F.col("lookup"), F.lower("canonical_name")))
        scored = scored.where("score > 0")
    else:
        scored = _reaching(asked, keys, canonical, cutoff)
    return scored.withColumn("score", python_round(F.col("score")))


def _reaching(asked: DataFrame, keys: DataFrame, canonical: DataFrame, cutoff: float) -> DataFrame:
    """The matches of match_fuzzy() with a score of `cutoff` or more.

    A ratio of c leaves (1 - c) of the letters of both strings to deletions and insertions, and the longer has (2 - c) / c of
    the shorter's letters at most: that is the budget of a lookup. An initial capital takes two of them.
    """
    names = cut_lineage(canonical.where("taxon_rank <> 'genus'").select("key", F.struct(F.lit(0).alias("kind"), F.col("prio").alias("prio"), F.col("ord").alias("ord")).alias("ord"), F.lower("canonical_name").alias("name")))
    # a little more than the budget: rounding must not lose a pair
    asked = cut_lineage(spread(asked, "lookup").withColumn("budget", F.floor(F.length("lookup") * F.lit(2 * (1 - cutoff) / cutoff) + 1e-6).cast("int")))
    near, short = within(asked, names, "name", capital=2)
    if short.take(1):  # so low a cutoff that any name may reach it
        near = near.unionByName(short.crossJoin(names)) if short.count() * names.count() <= MOST_PAIRS else near.unionByName(_blockwise(short, names))
    letters = F.length("lookup") + F.length("name")
    near = near.where((F.levenshtein("lookup", "name") <= F.lit(1 - cutoff + 1e-9) * letters) & (2.0 * F.least(F.length("lookup"), F.length("name")) >= F.lit(cutoff - 1e-9) * letters))
    scored = near.withColumn("score", indel_ratio(F.col("lookup"), F.col("name"))).where(F.col("score") >= cutoff)
    reaching = cut_lineage(scored.select("lookup", "key", "ord", "score", F.levenshtein("lookup", "key").alias("distance")))
    best = cut_lineage(reaching.groupBy("lookup").agg(F.min(F.struct("distance", "ord", "key")).alias("b"), F.min_by("score", F.struct("distance", "ord", "key")).alias("score")))
    # another key, nearer or as near and before it, takes its place
    rivals, close = within(best.select("lookup", F.col("b.distance").alias("budget")), keys.select("key", "ord"), "key")
    if close.take(1):
        rivals = rivals.unionByName(_blockwise(close, keys.select("key", "ord")))
    nearest = rivals.groupBy("lookup").agg(F.min(F.struct(F.levenshtein("lookup", "key").alias("distance"), "ord", "key")).alias("r"))
    kept = best.join(nearest, "lookup", "left").where("r IS NULL OR r.key = b.key").select("lookup", F.col("b.key").alias("key"), "score")
    return kept.join(sized(canonical), "key")


def _blockwise(asked: DataFrame, keys: DataFrame) -> DataFrame:
    """All pairs of rows, by blocks of keys that are spread over the tasks."""
    blocks = max(1, -(-keys.count() // BLOCK))
    marked = keys.withColumn("__block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    return asked.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(marked, "__block").drop("__block")


def best_options(matched: DataFrame, ids: list[str], strategy: str = "best_score") -> DataFrame:
    """One matched candidate of each line: best score, then longest option, then fewest tokens; or the first two the other way round."""
    score, size = F.col("score"), F.length("option")
    first, second = (score, size) if strategy == "best_score" else (size, score)
    order = F.struct((-first).alias("a"), (-second).alias("b"), "num_tokens", "i", (-F.col("j")).alias("j"))
    columns = [c for c in matched.columns if c not in ids]
    return matched.groupBy(*ids).agg(F.min_by(F.struct(*columns), order).alias("b")).select(*ids, "b.*")
