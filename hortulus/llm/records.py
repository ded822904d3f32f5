"""Records that differ in formatting only: normal forms, collapsing of copies, best representatives.

Formatting is whitespace, letter case, punctuation and the order in which the parts of a name are written. A rank
abbreviation together with the epithet it introduces, and the hybrid sign together with the word it marks, are one
part each, so epithets in other roles stay different.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hortulus.runtime import cut_lineage

# Words that introduce an infraspecific epithet.
RANK_WORDS = ("f", "fo", "forma", "var", "variet", "subsp", "ssp", "subvar", "convar", "cv", "nothosubsp", "nothovar")
# Marks of an absent author, after plain_form().
ABSENT_AUTHORS = ("", "na", "n a", "none", "null", "nil", "unknown", "not known", "no author", "anon", "anonymous", "missing", "unbekannt", "inconnu")
RANK_PATTERN = f"(?<= |^)({'|'.join(RANK_WORDS)}|×) (?=\\S)"


def plain_form(value: Column) -> Column:
    """Lower case, hyphens within words removed, other punctuation as blanks, single blanks. Null gives ''.

    The hybrid sign and '&' are no punctuation here: they tell names and author teams apart.
    """
    text = F.lower(F.coalesce(value.cast("string"), F.lit("")))
    text = F.regexp_replace(F.replace(text, F.lit("ß"), F.lit("ss")), "(?<=\\p{L})[-\u00ad‐‑‒–—](?=\\p{L})", "")
    text = F.regexp_replace(text, "([×&])", " $1 ")
    return F.trim(F.regexp_replace(text, "[^\\p{L}\\p{M}\\p{N}×&]+", " "))


def unordered_form(value: Column) -> Column:
    """plain_form() with its parts sorted; a rank word or hybrid sign stays with the word after it."""
    glued = F.regexp_replace(plain_form(value), RANK_PATTERN, "$1~")
    return F.array_join(F.array_sort(F.split(glued, " ")), " ")


def name_key(canonical: str, genus: str, epithet: str, infraspecific: str, rank: str) -> Column:
    """One string for all writings of a name, from the five columns."""
    pair = F.array_join(F.array_sort(F.array(plain_form(F.col(genus)), plain_form(F.col(epithet)))), "\u0001")
    return F.concat_ws("\u0002", unordered_form(F.col(canonical)), pair, plain_form(F.col(infraspecific)), plain_form(F.col(rank)))


def record_key(canonical: str, genus: str, epithet: str, infraspecific: str, rank: str, others: Sequence[str]) -> Column:
    """name_key() with further columns compared but for formatting."""
    return F.concat_ws("\u0002", name_key(canonical, genus, epithet, infraspecific, rank), *[plain_form(F.col(c)) for c in others])


def key_hash(key: Column) -> Column:
    """128 bits of a key: what is shuffled in its place. Two keys of a table of a billion billion of them fall on one with a probability under
    one in five hundred."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("\u0003"), key).alias("b"))


def names_an_author(value: Column) -> Column:
    """True where a string names an author; blanks, marks and words of absence and null don't."""
    plain = plain_form(value)
    return ~plain.isin(*ABSENT_AUTHORS) & plain.rlike("\\p{L}")


# ---------------------------------------------------------------- duplicates hidden by formatting


def hot_keys(keyed: DataFrame, key: str, max_hot: int = 2000, least: int = 10_000) -> DataFrame:
    """The keys that hold more than 1/max_hot of all rows (and at least `least` rows): exact, by partial counts.

    By this definition there are fewer than `max_hot` of them, however large the data: the bound of every broadcast here.
    """
    total = keyed.count()
    least = max(least, total // max_hot)
    return keyed.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > least).select(key)


def group_minima(keyed: DataFrame, key: str, ident: str, hot: DataFrame, salts: int = 64) -> tuple[DataFrame, DataFrame]:
    """(hot, cold): per key the smallest ident (`__min`) and the number of rows (`__copies`).

    Rows of hot keys are aggregated in two levels, first by (key, salt); the rest in one.
    """
    marked = keyed.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), key, "left")
    first = (
        marked.where(F.col("__hot"))
        .withColumn("__salt", F.pmod(F.xxhash64(ident), F.lit(salts)))
        .groupBy(key, "__salt")
        .agg(F.min(ident).alias("__min"), F.count(F.lit(1)).alias("__copies"))
    )
    two_level = first.groupBy(key).agg(F.min("__min").alias("__min"), F.sum("__copies").alias("__copies"))
    one_level = marked.where(F.col("__hot").isNull()).groupBy(key).agg(F.min(ident).alias("__min"), F.count(F.lit(1)).alias("__copies"))
    return two_level, one_level


def collapse_copies(df: DataFrame, ident: str, key: Column, max_hot: int = 2000, least: int = 10_000, salts: int = 64) -> DataFrame:
    """One row (ident, copies) for each group of rows with the same key; ident is the smallest of the group.

    Repeated rows count as copies. Rows with a null ident are counted but never represent a group unless all idents of
    it are null. An empty table gives none. Further columns are ignored, whatever their names.
    """
    keyed = cut_lineage(df.select(F.col(ident).alias("__ident"), key_hash(key).alias("__key")))  # normalised once
    hot, cold = group_minima(keyed, "__key", "__ident", hot_keys(keyed, "__key", max_hot, least), salts)
    return hot.unionByName(cold).select(F.col("__min").alias(ident), F.col("__copies").alias("copies"))


def copy_pairs(df: DataFrame, ident: str, key: Column, max_hot: int = 2000, least: int = 10_000, salts: int = 64) -> DataFrame:
    """(ord_a, ord_b): the smallest ident of each group of rows with the same key, with each other one.

    Hot groups never meet in one task: their minima come of the two-level aggregation and are broadcast (fewer than
    `max_hot`); the rows of the others find theirs in one shuffle by key. Rows with a null ident are left out; an ident
    that stands twice with the same key is one row.
    """
    keyed = cut_lineage(df.where(F.col(ident).isNotNull()).select(F.col(ident).alias("__ident"), key_hash(key).alias("__key")))  # normalised once
    hot, _ = group_minima(keyed, "__key", "__ident", hot_keys(keyed, "__key", max_hot, least), salts)
    joined = keyed.join(F.broadcast(hot.select("__key", "__min")), "__key", "left")
    large = joined.where(F.col("__min").isNotNull()).select("__min", "__ident")
    small = (
        joined.where(F.col("__min").isNull())
        .select("__ident", F.min("__ident").over(Window.partitionBy("__key")).alias("__min"))
        .select("__min", "__ident")
    )
    return large.unionByName(small).where(F.col("__min") < F.col("__ident")).select(F.col("__min").alias("ord_a"), F.col("__ident").alias("ord_b")).distinct()


# ---------------------------------------------------------------- best representative of each group


def field_votes(rows: DataFrame, fields: dict[str, tuple[Column, Column]], trust: Column, recency: Column) -> DataFrame:
    """Unpivots `fields` ({name: (value, is it usable)}) of (`__group`, `__ident`, `__priority`, `__time`) to long rows and
    sums the votes: one row for each (group, field, normalised value) with the sum of trust times recency, its first row, and the number and
    smallest ident of its rows. Unusable values are one, null, without a first row."""
    # in order of precedence, the larger first: known priority, time, smaller ident
    rank = F.struct(F.coalesce(-F.col("__priority"), F.lit(-(2**31))).alias("p"), F.coalesce(F.col("__time"), F.lit(-(2**62))).alias("t"), (-F.col("__ident")).alias("i"))
    entries = [
        F.struct(F.lit(field).alias("__field"), F.when(usable, F.coalesce(value.cast("string"), F.lit(""))).alias("__value")) for field, (value, usable) in fields.items()
    ]
    long = rows.select("__group", "__ident", (trust * recency).alias("__vote"), rank.alias("__rank"), F.inline(F.array(*entries)))
    form = F.when(F.col("__value").isNotNull(), F.xxhash64(plain_form(F.col("__value"))))
    return long.groupBy("__group", "__field", form.alias("__form")).agg(
        F.round(F.sum(F.when(F.col("__value").isNotNull(), F.col("__vote"))), 6).alias("__votes"),
        F.max(F.when(F.col("__value").isNotNull(), F.struct("__rank", "__value"))).alias("__best"),
        F.count(F.lit(1)).alias("__n"),
        F.min("__ident").alias("__least"),
    )


def best_representatives(
    df: DataFrame,
    sources: DataFrame,
    ident: str,
    group: Column,
    fields: dict[str, tuple[Column, Column]],
    source: str = "source",
    time: str = "loaded_at",
    policy: str = "votes",
    half_life_days: float = 365.0,
) -> DataFrame:
    """For each group of two or more rows the winning value of each field and the row it comes from.

    Fields are unpivoted to long rows, each row votes for its normalised value with (trust of its source) times (decay by
    age), the votes are summed per value, max_by chooses and the winners are pivoted back. Trust is 1 / priority (0 for an
    unknown source); a vote halves every `half_life_days` before the latest time in the table, and counts as one of ten half
    lives if the time is missing. policy "votes" takes the value with most votes, ties by precedence; policy "precedence"
    takes the value of the first row by priority, then latest time, then smallest ident, which no weighted sum can express.

    Result: group_ord (smallest ident), copies, and for each field f: f (the value as that row writes it) and f_ord (its
    ident), null where no row of the group has a usable one. `sources` (source, priority) is a small fixed table and is
    broadcast. Null idents never win; an empty table gives no rows. Both shuffles are of partial aggregates: a group of any size sends
    one row for each field, value and task.
    """
    if policy not in ("votes", "precedence"):
        raise ValueError(f"unknown policy {policy}")
    priorities = sources.groupBy(F.col("source").alias("__source")).agg(F.min("priority").alias("__priority"))
    rows = df.where(F.col(ident).isNotNull()).select(
        key_hash(group).alias("__group"),
        F.col(ident).cast("long").alias("__ident"),
        F.col(source).alias("__source"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("__time"),
        *[value.cast("string").alias(f"__v_{f}") for f, (value, _) in fields.items()],
        *[usable.alias(f"__u_{f}") for f, (_, usable) in fields.items()],
    )
    latest = df.where(F.col(ident).isNotNull()).agg(F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias("__latest"))
    rows = rows.join(F.broadcast(priorities), "__source", "left").crossJoin(F.broadcast(latest))
    age = (F.col("__latest") - F.col("__time")) / F.lit(86_400_000_000.0)
    recency = F.coalesce(F.pow(F.lit(0.5), age / F.lit(half_life_days)), F.lit(0.5**10))
    trust = F.coalesce(F.lit(1.0) / F.col("__priority"), F.lit(0.0))
    columns = {f: (F.col(f"__v_{f}"), F.col(f"__u_{f}")) for f in fields}
    votes = field_votes(rows, columns, trust, recency)
    order = F.struct("__votes", "__best") if policy == "votes" else F.struct("__best")
    one = next(iter(fields))
    pivoted = votes.groupBy("__group").agg(
        F.sum(F.when(F.col("__field") == one, F.col("__n"))).alias("copies"),
        F.min("__least").alias("group_ord"),
        *[F.max_by("__best", F.when((F.col("__field") == f) & F.col("__best").isNotNull(), order)).alias(f"__w_{f}") for f in fields],
    )
    chosen = [c for f in fields for c in (F.col(f"__w_{f}.__value").alias(f), (-F.col(f"__w_{f}.__rank.i")).alias(f"{f}_ord"))]
    return pivoted.where("copies > 1").select("group_ord", "copies", *chosen)
