"""Noise in text from scanned pages: running headers, page numbers, words broken by line ends, misread characters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hortulus.llm.encoding import MULTIBYTE_PAGES, decode_bytes
from hortulus.llm.words import Tables, one_relation
from hortulus.runtime import cut_lineage, spread

# What a letter or letter group is printed as when it is misread.
MISREADINGS = {
    "m": ("rn",),
    "w": ("vv",),
    "u": ("ii", "il", "li", "ll", "i1", "1i", "l1", "1l", "11", "n"),
    "d": ("cl", "ci", "c1"),
    "li": ("h",),
    "ri": ("n",),
    "rn": ("m",),
    "h": ("b",),
    "b": ("8", "h"),
    "t": ("f",),
    "f": ("t",),
    "e": ("c",),
    "c": ("e",),
    "n": ("u",),
    "i": ("l", "1"),
    "l": ("i", "1"),
    "o": ("0",),
    "s": ("5",),
    "g": ("6",),
}
# Words that may follow a hyphen that stands at the end of a line by right ("Samen- und ...").
AFTER_HANGING = ("und", "oder", "bzw", "et", "and", "or", "e", "ou")
HYPHENS = "-¬=‐­"
#: How a content begins that is XHTML.
XHTML = "^\\s*<(html|\\?xml|!DOCTYPE)"
#: A running header has so many characters at most.
LONGEST_HEADER = 90
#: Broadcast a dictionary of so many words at most (some 100 MB); a larger one is joined by shuffle.
MOST_WORDS = 2_000_000


def broken_hyphens() -> list[str]:
    """The forms of the break sign, also in text that was read in a wrong encoding once or twice."""
    once = [decode_bytes("¬".encode(), p) for p in MULTIBYTE_PAGES]
    twice = [decode_bytes(u.encode(), p) for u in once for p in MULTIBYTE_PAGES]
    return sorted({u.strip() for u in once + twice if u.strip()}, key=lambda u: (-len(u), u))


def _escaped(text: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in text)


def break_pattern() -> str:
    forms = "|".join(_escaped(u) for u in broken_hyphens())
    return f"(?:[{_escaped(HYPHENS)}]|{forms})\\s*$"


# ---------------------------------------------------------------- lines


def page_lines(tables: Tables, lines: str, files: str, file_of_line: str = "file_id", page: str = "page", line_nr: str = "line_nr") -> DataFrame:
    """(table_name, row_id, file, scope, paged, page, line_nr, text): the rows of a table of lines, and the lines of a table of whole
    files, plain or XHTML (a p per line). Page is null in the latter; paged says whether the file shows its pages. Scope is the
    source (garden), or the file if it has none. Null texts are ''. The files are parsed once: their lines are read several times."""
    df, ident, text, source = tables[lines]
    of_lines = df.select(
        F.lit(lines).alias("table_name"),
        F.col(ident).cast("long").alias("row_id"),
        F.concat(F.lit("l"), F.coalesce(F.col(file_of_line).cast("string"), F.lit(""))).alias("file"),
        _scope(F.col(source), "l", F.col(file_of_line)),
        F.col(page).isNotNull().alias("paged"),
        F.col(page).cast("int").alias("page"),
        F.col(line_nr).cast("int").alias("line_nr"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    df, ident, text, source = tables[files]
    content = F.col(text).cast("string")
    each = F.when(content.rlike(XHTML), _paragraphs(content)).otherwise(F.split(content, "\r\n|\n|\r"))
    of_files = df.where(content.isNotNull()).select(
        F.lit(files).alias("table_name"),
        F.col(ident).cast("long").alias("row_id"),
        F.concat(F.lit("c"), F.col(ident).cast("string")).alias("file"),
        _scope(F.col(source), "c", F.col(ident)),
        (content.rlike(XHTML) & content.contains("<div")).alias("paged"),
        F.lit(None).cast("int").alias("page"),
        F.posexplode(each).alias("line_nr", "text"),
    )
    return of_lines.unionByName(cut_lineage(of_files))


def _scope(source: Column, kind: str, file: Column) -> Column:
    own = F.concat(F.lit(f"\x01{kind}"), F.coalesce(file.cast("string"), F.lit("")))
    return F.coalesce(F.nullif(source.cast("string"), F.lit("")), own).alias("scope")


def _paragraphs(content: Column) -> Column:
    return F.transform(
        F.regexp_extract_all(content, F.lit("(?s)<p[^>]*>(.*?)</p>"), F.lit(1)),
        lambda p: F.replace(F.replace(F.replace(p, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&")),
    )


def division_tops(tables: Tables, files: str) -> DataFrame:
    """(scope, text): the first short line with a word of each page but the first of XHTML files, where a div is a page."""
    df, ident, text, source = tables[files]
    content = F.col(text).cast("string")
    pages = F.slice(F.split(content, "<div\\b"), 3, MOST_WORDS)  # what stands before the first div, and the first page
    each = df.where(content.rlike(XHTML)).select(_scope(F.col(source), "c", F.col(ident)), F.explode(pages).alias("p"))
    return each.select("scope", F.get(F.filter(_paragraphs(F.col("p")), lambda t: (F.length(t) <= LONGEST_HEADER) & t.rlike("\\p{L}{3}")), F.lit(0)).alias("text")).where("text IS NOT NULL")


# ---------------------------------------------------------------- glyphs


def glyph_skeleton(word: Column) -> Column:
    """The strokes of a word's letters: a misread word has the same ones as the printed one, since every misreading above keeps
    them. Other words may have them too, so who shares a skeleton is still to be tested by is_misreading()."""
    strokes = F.translate(F.lower(word), "l1|!rhbu8n0f5c6", "iiiiinnnnnotseg")
    for letter, form in (("n", "ii"), ("m", "iii"), ("d", "ei"), ("w", "vv")):
        strokes = F.replace(strokes, F.lit(letter), F.lit(form))
    return strokes


def is_misreading(printed: str, read: str) -> bool:
    """Whether `read` comes of `printed` by misread glyphs alone, and not by a slip such as two letters changed about."""
    if printed == read:
        return False
    if len(printed) == len(read):
        differ = [i for i, (a, b) in enumerate(zip(printed, read)) if a != b]
        if len(differ) == 2 and differ[1] == differ[0] + 1 and printed[differ[0]] == read[differ[1]] and printed[differ[1]] == read[differ[0]]:
            return False
    reach = {(0, 0)}
    open_ = [(0, 0)]
    while open_:
        i, j = open_.pop()
        if (i, j) == (len(printed), len(read)):
            return True
        steps = [(i + 1, j + 1)] if i < len(printed) and j < len(read) and printed[i] == read[j] else []
        for size in (1, 2):
            for form in MISREADINGS.get(printed[i : i + size], ()) if i + size <= len(printed) else ():
                if read.startswith(form, j):
                    steps.append((i + size, j + len(form)))
        for step in steps:
            if step not in reach:
                reach.add(step)
                open_.append(step)
    return False


def name_words(text: str) -> Column:
    """The words of a text that may be part of a name: letters, and digits for letters, in lower case. (A regex alone: functions
    over arrays would take the plan out of generated code.)"""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9|!]{4,40}"), F.lit(0))


def vocabulary(dictionary: DataFrame, name: str, trusted: str, least: int = 2) -> DataFrame:
    """(word, n): the words of the names of a dictionary: those that stand in `least` names or in a trusted one."""
    words = dictionary.select(F.explode(name_words(name)).alias("word"), F.col(trusted).cast("int").alias("t"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("t")).where((F.col("n") >= least) | (F.col("t") == 1)).select("word", "n")


AROUND = ("before2", "before", "behind", "behind2")


def with_neighbours(rows: DataFrame, suspects: DataFrame | None = None) -> DataFrame:
    """The columns of rows (text) with (word, before2, before, behind, behind2) in place of the text: each of its name words with its
    neighbours, or only those of `suspects` (word). The neighbours are looked up for the words that are put out only."""
    others = [c for c in rows.columns if c != "text"]
    if suspects is not None:
        if suspects.count() > MOST_WORDS:  # no array goes through a shuffle: the words are put out with their neighbours, then joined
            return with_neighbours(rows).join(suspects, "word").select(*others, "word", *AROUND)
        # the text goes along, not its words: an array copied for every word costs more than taking apart the few texts that are met
        each = rows.select(*others, "text", F.posexplode(name_words("text")).alias("__i", "word"))
        each = each.join(F.broadcast(suspects), "word").select(*others, "__i", "word", name_words("text").alias("__words"))
    else:
        each = rows.select(*others, name_words("text").alias("__words"))
        each = each.select(*others, "__words", F.posexplode("__words").alias("__i", "word"))
    steps = zip(AROUND, (-2, -1, 1, 2))
    return each.select(*others, "word", *[F.get("__words", F.col("__i") + k).alias(name) for name, k in steps])


def contexts(tokens: DataFrame) -> DataFrame:
    """(word, context, c) of (word, before2, before, behind, behind2, n): how often a word has each neighbour within two words, each row
    counting n times. A neighbour counts by its glyph skeleton, so a misread one is the same neighbour."""
    each = tokens.select("word", "n", F.explode(F.array(*AROUND)).alias("w")).where("w IS NOT NULL")
    # skeletons are made of distinct pairs, not of every occurrence
    counted = each.groupBy("word", "w").agg(F.sum("n").alias("c"))
    return counted.groupBy("word", glyph_skeleton(F.col("w")).alias("context")).agg(F.sum("c").alias("c"))


def skip_grams(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """(word, context, weight) of (text): the vectors of the `wanted` words (word). Skip-gram training with one negative sample factorises the
    matrix of pointwise mutual informations (Levy and Goldberg 2014); these are its rows themselves, positive ones only, at length 1."""
    # the same words in the same order are one name, however it is written
    distinct = names.groupBy(F.array_join(name_words("text"), " ").alias("text")).agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(contexts(with_neighbours(distinct)))
    total = counted.agg(F.sum("c")).first()[0] or 0
    of_word, of_context = counted.groupBy("word").agg(F.sum("c").alias("n_word")), counted.groupBy("context").agg(F.sum("c").alias("n_context"))
    information = F.log(F.col("c") * F.lit(float(total)) / (F.col("n_word") * F.col("n_context")))
    weighted = counted.join(_bounded(wanted), "word", "left_semi").join(of_word, "word").join(of_context, "context").select("word", "context", information.alias("weight")).where("weight > 0")
    square = F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("word"))
    return weighted.select("word", "context", (F.col("weight") / F.sqrt(square)).alias("weight"))


def _bounded(df: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """With a broadcast hint if it is small enough, else for Spark to join by shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def misread_words(rows: DataFrame, names: DataFrame, words: DataFrame, rare: float = 0.5, similar: float = 0.1) -> DataFrame:
    """(table_name, row_id, file, line_nr, word, printed): the misread words of rows (table_name, row_id, file, line_nr, text).

    All distinct words are counted; those outside the vocabulary (word, n) are linked by glyph skeleton to vocabulary words from which
    they come by misreadings alone. How near the contexts of a word are to the skip-gram vector of each printed one (learned from `names`
    (text)) is a cosine; the printed word of the highest is taken, then the most frequent. The word is a misreading of it if the cosine is
    `similar` at least, or if there are no more of it than `rare` times the number of the printed one: a rare word beside a frequent one
    needs no context, one that is frequent itself must stand in the same contexts, else it is a word of its own.
    """
    known = cut_lineage(words)
    counts = cut_lineage(rows.select(F.explode(name_words("text")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    keyed = known.select(F.col("word").alias("printed"), glyph_skeleton(F.col("word")).alias("skeleton")).groupBy("skeleton").agg(F.collect_set("printed").alias("printed"))
    strange = spread(counts.join(_bounded(known.select("word")), "word", "left_anti"), "word")
    linked = strange.withColumn("skeleton", glyph_skeleton(F.col("word"))).join(_bounded(keyed), "skeleton").select("word", "n", F.explode("printed").alias("printed"))

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[[is_misreading(p, w) for p, w in zip(frame["printed"], frame["word"])]]

    pairs = cut_lineage(linked.mapInPandas(verify, "word string, n long, printed string"))
    suspects = pairs.select("word").distinct()
    found = cut_lineage(with_neighbours(rows.select("table_name", "row_id", "file", "line_nr", "text"), suspects))
    printed = cut_lineage(pairs.select(F.col("printed").alias("word")).distinct())
    near = _nearness(pairs, cut_lineage(contexts(found.withColumn("n", F.lit(1)))), skip_grams(names, printed))
    frequent = counts.join(printed, "word", "left_semi").select(F.col("word").alias("printed"), F.col("n").alias("n_text"))
    listed = known.select(F.col("word").alias("printed"), F.col("n").alias("n_listed"))
    scored = pairs.join(near, ["word", "printed"], "left").join(frequent, "printed", "left").join(listed, "printed", "left")
    n_printed = F.coalesce("n_text", F.lit(0)) + F.coalesce("n_listed", F.lit(0))
    scored = scored.select("word", "n", "printed", F.coalesce("near", F.lit(0.0)).alias("near"), n_printed.alias("n_printed"))
    best = scored.groupBy("word", "n").agg(F.max(F.struct("near", "n_printed", "printed")).alias("b"))
    accepted = cut_lineage(best.where((F.col("b.near") >= similar) | (F.col("n") <= F.lit(rare) * F.col("b.n_printed"))).select("word", F.col("b.printed").alias("printed")))
    return found.select("table_name", "row_id", "file", "line_nr", "word").distinct().join(_bounded(accepted), "word")


def _nearness(pairs: DataFrame, seen: DataFrame, vectors: DataFrame) -> DataFrame:
    """(word, printed, near): the cosine of the contexts (word, context, c) of each word and the vector of each printed one."""
    length = seen.groupBy("word").agg(F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("length"))
    own = pairs.select("word", "printed").join(seen, "word")
    dots = own.join(vectors.withColumnRenamed("word", "printed"), ["printed", "context"]).groupBy("word", "printed").agg(F.sum(F.col("c") * F.col("weight")).alias("dot"))
    return dots.join(length, "word").select("word", "printed", F.round(F.col("dot") / F.col("length"), 6).alias("near"))


# ---------------------------------------------------------------- furniture


NUMERAL = "(?:\\d{1,3}|[\\dlIO]{1,3}|[ivxlc]{1,6})"
DECORATED = f"^\\s*(?:\\[{NUMERAL}\\]|(?:pag|p|Seite|S|page)\\.? ?{NUMERAL}|([^\\p{{L}}\\p{{N}}\\s]|\\S{{2,9}}) {NUMERAL} \\1)\\s*$"
ROMAN = "^\\s*(?=[ivxlc])(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})\\s*$"
BARE = "^\\s*(?:\\d{1,2}|[\\dlIO]{1,2})\\s*$"
FULL = "^\\s*\\d{3}\\s*$"


def page_numbers(lines: DataFrame, reach: int = 2) -> DataFrame:
    """The lines that give the page: numerals set off by brackets, dashes or a word for page, small roman ones, and bare ones of
    one or two digits within `reach` lines of a page's edge. There bare ones of three digits count if a number of another page of the
    file is as far from its page; in files without pages, if the number line before or behind gives the number before or behind."""
    # short ones first: the patterns are tried on few lines
    looks = lines.where((F.length(F.trim("text")) <= 16) & (F.col("text").rlike(DECORATED) | F.col("text").rlike(ROMAN) | F.col("text").rlike(BARE) | F.col("text").rlike(FULL)))
    edges = lines.where("page IS NOT NULL").groupBy("file", "page").agg(F.min("line_nr").alias("top"), F.max("line_nr").alias("bottom"))
    looks = looks.join(edges, ["file", "page"], "left")
    sure = F.col("text").rlike(DECORATED) | F.col("text").rlike(ROMAN)
    at_edge = F.col("page").isNull() | (F.col("line_nr") - F.col("top") <= reach) | (F.col("bottom") - F.col("line_nr") <= reach)
    looks = looks.where(sure | at_edge).withColumn("full", F.col("text").rlike(FULL)).withColumn("number", F.regexp_extract("text", "\\d{1,3}", 0).try_cast("int"))
    looks = cut_lineage(looks.select("table_name", "row_id", "file", "page", "line_nr", "text", "full", "number"))
    columns = ("table_name", "row_id", "file", "page", "line_nr", "text")
    apart = looks.where("page IS NOT NULL AND number IS NOT NULL").select("file", (F.col("number") - F.col("page")).alias("apart"), "page")
    shared = apart.groupBy("file", "apart").agg(F.min("page").alias("first"), F.max("page").alias("last")).where("first < last").select("file", "apart")
    full = looks.where("full").withColumn("apart", F.col("number") - F.col("page")).join(shared, ["file", "apart"], "left_semi")
    # only files with such a line
    loose = looks.where("page IS NULL AND number IS NOT NULL").join(looks.where("full AND page IS NULL").select("file").distinct(), "file", "left_semi")
    by_line = Window.partitionBy("file").orderBy("line_nr")
    loose = loose.withColumns({"before": F.lag("number").over(by_line), "behind": F.lead("number").over(by_line)})
    runs_on = loose.where("full AND (before = number - 1 OR behind = number + 1)")
    return looks.where("NOT full").select(*columns).unionByName(full.select(*columns)).unionByName(runs_on.select(*columns))


def header_key(text: Column) -> Column:
    """The glyph skeleton of the first two words of three letters or more (digits may stand for letters, but one is a letter): the same for a
    misread header. '' without a word."""
    letter = "[\\p{L}0-9|!]"
    word = f"(?=[0-9|!]*\\p{{L}}){letter}{{3,}}"
    pattern = f"(?s)^.*?({word})(?:[^\\p{{L}}0-9|!].*?({word}))?"
    both = F.concat(F.regexp_extract(text, pattern, 1), F.lit(" "), F.regexp_extract(text, pattern, 2))
    return glyph_skeleton(F.rtrim(both))


def first_word_key(text: Column) -> Column:
    """The skeleton of the first word behind a number, cheap enough for every line."""
    return glyph_skeleton(F.regexp_extract(text, "^\\s*(?:[\\d\\W]+\\s+)?(\\S+)", 1))


#: (pages that a key opens, share of its lines that do): what makes it a running header of one garden, and of all.
OF_SCOPE = ((2, 0.7), (3, 0.5))
OF_ALL = ((3, 0.5), (30, 0.3))


def running_headers(lines: DataFrame, divisions: DataFrame) -> DataFrame:
    """The running headers: lines whose key opens pages but the first of files, in their garden (file, if it has none) or anywhere,
    as often as OF_SCOPE or OF_ALL say: counts that don't grow with the input. The first line of a file is its title.

    Keys are learned from the first lines of pages, those of `divisions` (scope, text) included; all lines are then sieved by
    their first word. What is learned is a table that is joined.
    """
    short = lines.where((F.col("line_nr") > 0) & (F.length("text") <= LONGEST_HEADER))
    tops = short.where("page > 1").where(F.col("text").rlike("\\p{L}{3}")).groupBy("scope", "file", "page").agg(F.min(F.struct("line_nr", "text")).alias("top"))
    tops = tops.select("scope", F.col("top.text").alias("text")).unionByName(divisions)
    tops = tops.select("scope", header_key(F.col("text")).alias("key"), first_word_key(F.col("text")).alias("first")).where("key <> ''")
    counted = cut_lineage(tops.groupBy("scope", "key", "first").agg(F.count(F.lit(1)).alias("n")))
    least = lambda rule: min(n for n, _ in rule)
    of_scope = counted.groupBy("scope", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= least(OF_SCOPE))
    of_all = counted.groupBy("key").agg(F.sum("n").alias("n_all")).where(F.col("n_all") >= least(OF_ALL))
    # "" stands for every scope
    sieve = counted.join(of_scope.select("scope", "key"), ["scope", "key"], "left_semi").select("scope", "first")
    sieve = sieve.unionByName(counted.join(of_all.select("key"), "key", "left_semi").select(F.lit("").alias("scope"), "first"))
    sieve = cut_lineage(sieve.groupBy("first").agg(F.collect_set("scope").alias("scopes")))
    hits = short.withColumn("first", first_word_key(F.col("text"))).join(_bounded(sieve), "first").where(F.array_contains("scopes", "") | F.array_contains("scopes", F.col("scope")))
    hits = hits.withColumn("key", header_key(F.col("text"))).drop("first", "scopes")
    hits = hits.join(_bounded(of_scope), ["scope", "key"], "left").join(_bounded(of_all), "key", "left").where("n IS NOT NULL OR n_all IS NOT NULL")
    hits = cut_lineage(hits.select("table_name", "row_id", "file", "scope", "paged", "page", "line_nr", "text", "key", "n", "n_all"))
    passes = lambda rule, n, total: reduce(Column.__or__, [(n >= a) & (n >= F.lit(b) * total) for a, b in rule])
    by_scope = cut_lineage(hits.groupBy("scope", "key").agg(F.max("n").alias("n"), F.max("n_all").alias("n_all"), F.sum(F.col("paged").cast("int")).alias("total")))
    everywhere = by_scope.groupBy("key").agg(F.max("n_all").alias("n_all"), F.sum("total").alias("total"))
    in_scope = by_scope.where(passes(OF_SCOPE, F.col("n"), F.col("total"))).select("scope", "key", F.lit(True).alias("here"))
    in_all = everywhere.where(passes(OF_ALL, F.col("n_all"), F.col("total"))).select("key", F.lit(True).alias("anywhere"))
    found = hits.join(_bounded(in_scope), ["scope", "key"], "left").join(_bounded(in_all), "key", "left").where("here OR anywhere")
    return found.select("table_name", "row_id", "file", "page", "line_nr", "text")


# ---------------------------------------------------------------- broken words


def broken_words(lines: DataFrame, skip: DataFrame, ahead: int = 4) -> DataFrame:
    """(table_name, row_id, file, line_nr, half, rest, next_nr): lines that end within a word, and how it goes on.

    The next line is the first of the `ahead` following ones that is neither blank nor furniture (`skip`: file, line_nr); lines
    meet by (file, line_nr), so a file of any length is spread over all tasks. A hyphen in a code, after a number or before
    a word of AFTER_HANGING breaks nothing; in capitals a word goes on in capitals.
    """
    # the last word holds the sign: the many forms of it are not looked for in the rest of the line
    half = F.regexp_extract("tail", "([\\p{L}\\p{M}0-9]+)" + break_pattern(), 1)
    before = F.regexp_extract("tail", "(\\S*)" + break_pattern(), 1)
    last = sorted({u[-1] for u in broken_hyphens()} | set(HYPHENS))
    # the last character alone rules out most lines before any pattern is tried
    ends = lines.where(F.substring(F.rtrim("text"), -1, 1).isin(last)).withColumn("tail", F.substring_index(F.rtrim("text"), " ", -1))
    ends = ends.where(F.col("tail").rlike("\\p{L}" + break_pattern())).select("table_name", "row_id", "file", "line_nr", half.alias("half"), before.alias("token"))
    ends = ends.where(~F.col("token").rlike("^[A-Z]{2}[-.]\\S*$") | ~F.col("token").rlike("[-.][0-9O]"))
    start = F.regexp_extract("text", "^\\s*([\\p{L}\\p{M}]+)", 1)
    heads = lines.where(F.length(F.trim("text")) > 0).select("file", F.col("line_nr").alias("next_nr"), start.alias("rest"))
    steps = ends.withColumn("next_nr", F.explode(F.transform(F.sequence(F.lit(1), F.lit(ahead)), lambda k: F.col("line_nr") + k)))
    furniture = skip.select("file", F.col("line_nr").alias("next_nr")).distinct()
    met = steps.join(heads, ["file", "next_nr"]).join(furniture, ["file", "next_nr"], "left_anti")
    met = met.groupBy("table_name", "row_id", "file", "line_nr", "half").agg(F.min(F.struct("next_nr", "rest")).alias("next"))
    rest = F.col("next.rest")
    lower = rest.rlike("^\\p{Ll}") & ~F.lower(rest).isin(*AFTER_HANGING)
    upper = rest.rlike("^\\p{Lu}{2,}$") & F.col("half").rlike("^\\p{Lu}{2,}$")
    return met.where(lower | upper).select("table_name", "row_id", "file", "line_nr", "half", rest.alias("rest"), F.col("next.next_nr").alias("next_nr"))


def broken_names(names: DataFrame, words: DataFrame) -> DataFrame:
    """(table_name, row_id) of (table_name, row_id, text): names with a break left in: a break sign or hyphen with a blank within a
    word; a hyphen alone only if the word without it is in the vocabulary (else it is a compound)."""
    signs = f"(?:[{_escaped('¬=')}]|{'|'.join(_escaped(u) for u in broken_hyphens())})"
    # every sign is a hyphen, = or has a character beyond ASCII; each broken form has one, so that the many forms are tried on few names
    names = names.where(F.col("text").rlike("[-=]|[^\\x00-\\x7F]"))
    odd = F.col("text").rlike("=|[^\\x00-\\x7F]")
    sure = (odd & F.col("text").rlike(f"\\p{{L}}{signs}\\s*\\p{{L}}")) | F.col("text").rlike(f"\\p{{L}}[{_escaped(HYPHENS)}]\\s+\\p{{Ll}}")
    certain = names.where(sure).select("table_name", "row_id")
    compounds = names.where(~sure & F.col("text").rlike("\\p{L}[-‐]\\p{L}")).select(
        "table_name", "row_id", F.explode(F.transform(F.regexp_extract_all("text", F.lit("[A-Za-z]+[-‐][A-Za-z]+"), F.lit(0)), lambda w: F.lower(F.regexp_replace(w, "[-‐]", "")))).alias("word")
    )
    return certain.unionByName(compounds.join(_bounded(words.select("word")), "word", "left_semi").select("table_name", "row_id"))


# ---------------------------------------------------------------- all together


class Noise:
    """What was found in a set of tables; each part is a DataFrame."""

    def __init__(self, tables: Tables, lines: str, files: str, entries: str | None, dictionary: DataFrame, name: str = "name", trusted: str = "trusted"):
        self.lines = page_lines(tables, lines, files)
        self.headers = cut_lineage(running_headers(self.lines, division_tops(tables, files)))
        self.numbers = cut_lineage(page_numbers(self.lines))
        furniture = self.headers.select("file", "line_nr").unionByName(self.numbers.select("file", "line_nr"))
        self.breaks = broken_words(self.lines, furniture)
        words = cut_lineage(vocabulary(dictionary, name, trusted))
        rows = self.lines.select("table_name", "row_id", "file", "line_nr", "text")
        self.name_breaks = None
        names = dictionary.select(F.col(name).cast("string").alias("text"))
        if entries is not None:
            own = one_relation({entries: tables[entries]}).where("text IS NOT NULL").select("table_name", "row_id", "text")
            names = names.unionByName(own.select("text"))
            rows = rows.unionByName(own.select("table_name", "row_id", F.lit(None).cast("string").alias("file"), F.lit(None).cast("int").alias("line_nr"), "text"))
            self.name_breaks = broken_names(own, words)
        # a misread header is only a header
        self.misread = misread_words(rows, names, words).join(self.headers.select("file", "line_nr").distinct(), ["file", "line_nr"], "left_anti").select("table_name", "row_id", "line_nr", "word", "printed")


def find_noise(*args, **options) -> DataFrame:
    """(table_name, row_id, kind): each row with each kind of noise in it: header, page_number, hyphen, misread.

    Takes what Noise takes: a table of lines, one of whole files, optionally one of names, and a dictionary (name, is it trusted)
    that gives the vocabulary of names. Names are looked for in the whole of each line. Null and empty texts have no noise; a line
    delivered twice counts for each row; empty tables give nothing; other columns are ignored.
    """
    noise = Noise(*args, **options)
    parts = [(noise.headers, "header"), (noise.numbers, "page_number"), (noise.breaks, "hyphen"), (noise.misread, "misread")]
    if noise.name_breaks is not None:
        parts.append((noise.name_breaks, "hyphen"))
    out = None
    for df, kind in parts:
        one = df.select("table_name", "row_id", F.lit(kind).alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def repair_pages(*args, **options) -> DataFrame:
    """(file, page, text): each page as continuous text: furniture dropped, broken words mended on the line where they begin,
    misread words replaced, lines joined by blanks, and blank lines kept as paragraph ends. Whole files have page null.

    A page is the unit that is put together; lines that were delivered twice are taken once (the later row).
    """
    noise = Noise(*args, **options)
    furniture = noise.headers.select("file", "line_nr").unionByName(noise.numbers.select("file", "line_nr")).distinct()
    once = noise.lines.groupBy("file", "line_nr").agg(F.max(F.struct("row_id", "table_name", "page", "text")).alias("l")).select("file", "line_nr", "l.*")
    kept = once.join(furniture, ["file", "line_nr"], "left_anti")
    fixes = noise.misread.where("line_nr IS NOT NULL").groupBy("table_name", "row_id", "line_nr").agg(F.map_from_entries(F.collect_set(F.struct("word", "printed"))).alias("fixes"))
    begun = noise.breaks.groupBy("file", "line_nr").agg(F.max("rest").alias("rest"))
    ended = noise.breaks.groupBy("file", F.col("next_nr").alias("line_nr")).agg(F.max("rest").alias("taken"))
    joined = kept.join(fixes, ["table_name", "row_id", "line_nr"], "left").join(begun, ["file", "line_nr"], "left").join(ended, ["file", "line_nr"], "left")
    text = F.when(F.col("taken").isNotNull(), F.regexp_replace("text", "^\\s*[\\p{L}\\p{M}]+\\s*", "")).otherwise(F.trim("text"))
    text = F.when(F.col("rest").isNotNull(), F.concat(F.regexp_replace(text, break_pattern(), ""), F.col("rest"))).otherwise(text)
    words = F.transform(F.split(text, " "), lambda w: F.coalesce(_recased(F.element_at("fixes", F.lower(w)), w), w))
    text = F.when(F.col("fixes").isNotNull(), F.array_join(words, " ")).otherwise(text)
    whole = joined.select("file", "page", "line_nr", text.alias("text")).groupBy("file", "page").agg(F.sort_array(F.collect_list(F.struct("line_nr", "text"))).alias("all"))
    flowed = F.array_join(F.transform("all", lambda x: F.when(x["text"] == "", F.lit("\n\n")).otherwise(x["text"])), " ")
    return whole.select("file", "page", F.regexp_replace(flowed, " ?\n\n[\n ]*", "\n\n").alias("text"))


def _recased(fixed: Column, like: Column) -> Column:
    first = F.substring(like, 1, 1)
    return F.when(fixed.isNull(), fixed).when(F.upper(like) == like, F.upper(fixed)).when(F.upper(first) == first, F.concat(F.upper(F.substring(fixed, 1, 1)), F.substring(fixed, 2, 100))).otherwise(fixed)
