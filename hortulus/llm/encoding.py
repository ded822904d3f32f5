"""Text garbled by a wrong character encoding: finding it and restoring it.

A code-page swap is treated as a substitution cipher of unknown key. Per source, expectation-maximisation learns how often
each swap occurs and which letter each garbled symbol stands for, judged by bigrams of the letters of the corpus; the cipher
text of a multi-byte encoding is a sequence of symbols, which stands for one letter as a single symbol does. Work is done on
the distinct words of each source, so its size follows the vocabulary and not the text.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hortulus.llm.lookalike import CYRILLIC, CYRILLIC_AS_LATIN, GREEK, GREEK_AS_LATIN, INVISIBLE
from hortulus.llm.words import Tables, matching_words, one_relation, replace_words, rows_with_words
from hortulus.runtime import cut_lineage

# Names of code pages in common use, of which any may have been taken for any other.
PAGES = ("cp1252", "cp437", "cp850", "mac_roman", "cp1250", "cp1251", "koi8-r", "cp866")
MULTIBYTE_PAGES = (*PAGES, "latin-1", "cp1254")
LITERAL = "literal"
LOST = "lost"
#: How much likelier (in logs) the letters of a word must be in another page for the page to be considered.
GAIN = 3.0
# Words that may hold anything garbled: they have a character beyond ASCII, or a question mark between letters.
SUSPECT = "[^\\x00-\\x7F]|\\p{L}\\?\\p{L}"
EDGE = " "
LOOKS_LATIN = str.maketrans(CYRILLIC + GREEK, CYRILLIC_AS_LATIN + GREEK_AS_LATIN, INVISIBLE)


def decode_bytes(data: bytes, page: str) -> str:
    """As lenient readers do it: a byte without a character in the page becomes the control character of its number."""
    out = []
    for byte in data:
        try:
            out.append(bytes([byte]).decode(page))
        except UnicodeDecodeError:
            out.append(chr(byte))
    return "".join(out)


@functools.cache
def single_swaps() -> dict[str, dict[int, str]]:
    """Each pair of pages as a table for str.translate(): what a byte of the one is in the other. A letter never stands for a
    sign, nor a blank for anything."""
    upper = [bytes([b]) for b in range(0x80, 0x100)]
    pages = {p: [decode_bytes(b, p) for b in upper] for p in PAGES}
    return {
        f"{right}>{wrong}": {ord(w): r for w, r in zip(pages[wrong], pages[right]) if w != r and ord(w) > 0xA0 and (r.isalpha() or not w.isalpha())}
        for right in PAGES
        for wrong in PAGES
        if right != wrong
    }


def multibyte_units(alphabet: str) -> dict[str, tuple[re.Pattern, dict[str, str]]]:
    """By page: a pattern of the symbol sequences that letters of the alphabet become if UTF-8 is read as that page, once
    or twice, and the letter of each."""
    out = {}
    for page in MULTIBYTE_PAGES:
        once = {decode_bytes(c.encode("utf-8"), page): c for c in alphabet}
        twice = {decode_bytes(u.encode("utf-8"), page): c for u, c in once.items()}
        units = {u: c for u, c in (twice | once).items() if u not in alphabet}
        ordered = sorted(units, key=len, reverse=True)
        out[f"utf-8>{page}"] = (re.compile("|".join(map(re.escape, ordered)) or "(?!)"), units)
    return out


def looks_broken(word: str) -> bool:
    """Signs that need no statistics: replacement and control characters, letters of two scripts or box drawing in a word."""
    scripts = set()
    for c in word:
        if c == "�" or "\x7f" <= c <= "\x9f":
            return True
        if c > "\x7f":
            kind = unicodedata.category(c)
            if "─" <= c <= "▟":
                return True
            if kind[0] == "L":
                scripts.add(unicodedata.name(c, "?").split(" ")[0])
        elif c.isalpha():
            scripts.add("LATIN")
    return len(scripts - {"MODIFIER", "FULLWIDTH"}) > 1


def word_score(word: str, bigrams: dict[str, float], floor: float) -> float:
    total, before = 0.0, EDGE
    for c in word.lower() + EDGE:
        total += bigrams.get(before + c, floor)
        before = c
    return total


class Decoder:
    """Proposes the readings of a word under each swap, with the log probability of its letters."""

    def __init__(self, bigrams: dict[str, float], floor: float, alphabet: str):
        self.bigrams, self.floor, self.alphabet = bigrams, floor, set(alphabet)
        self.units = multibyte_units(alphabet)
        self.any_unit = set("".join(u for _, units in self.units.values() for u in units))

    def readings(self, word: str) -> list[tuple[str, str, float]]:
        """(swap, reading, score), the literal one first; only readings made of known letters that score higher."""
        own = literal = word_score(word, self.bigrams, self.floor)
        unified = word.translate(LOOKS_LATIN)
        if unified != word and re.search("[A-Za-z]", word):  # look-alikes are no garbling
            literal = max(literal, word_score(unified, self.bigrams, self.floor))
        out = [(LITERAL, word, literal)]
        if "�" in word or any("\x80" <= c <= "\x9f" and c != "\x85" for c in word) or re.search(r"[^\W\d_]\?[^\W\d_]", word):
            out.append((LOST, word, literal))
        seen = {word}
        if not self.any_unit.isdisjoint(word):
            for swap, (pattern, units) in self.units.items():
                reading = pattern.sub(lambda m: units[m.group()], word)
                if reading not in seen:
                    seen.add(reading)
                    out.append((swap, reading, word_score(reading, self.bigrams, self.floor)))
        odd = [c for c in word if c > "\x7f"] if unified == word or literal == own else []
        for swap, table in single_swaps().items():
            if any(ord(c) in table for c in odd):
                reading = word.translate(table)
                if reading not in seen and all(c < "\x80" or c in self.alphabet for c in reading):
                    seen.add(reading)
                    score = word_score(reading, self.bigrams, self.floor)
                    if score > literal + GAIN:
                        out.append((swap, reading, score))
        return out


def letter_bigrams(words: DataFrame) -> DataFrame:
    """(pair, n) of (word, n): pairs of neighbouring lower-case letters, the edge being a blank. At most alphabet squared rows."""
    # split once, so that a word of any length takes linear time
    letters = words.select(F.split(F.concat(F.lit(EDGE), F.lower("word"), F.lit(EDGE)), "").alias("c"), "n")
    pairs = F.zip_with(F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: F.concat(a, b))
    return letters.select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))


def learn_letters(words: DataFrame, least: int = 3) -> tuple[dict[str, float], float, str]:
    """Log probabilities of the bigrams of whole-looking words, that of one never seen, and the alphabet beyond ASCII.

    The table has at most one row for each pair of characters of the corpus: its size is bounded by the alphabet.
    """
    counts = {r["pair"]: r["n"] for r in letter_bigrams(words).collect()}
    totals: dict[str, float] = {}
    seen: dict[str, float] = {}
    for pair, n in counts.items():
        if len(pair) == 2:
            totals[pair[0]] = totals.get(pair[0], 0) + n
            seen[pair[1]] = seen.get(pair[1], 0) + n
    kinds = max(1, len(totals))
    bigrams = {p: math.log((n + 0.01) / (totals[p[0]] + 0.01 * kinds)) for p, n in counts.items() if len(p) == 2}
    largest = max(seen.values(), default=1)
    floor = math.log(0.01 / (largest + 0.01 * kinds))
    common = max(least, 2e-6 * sum(seen.values()))
    letters = {c for c, n in seen.items() if n >= common and c > "\x9f" and c != "�"}
    return bigrams, floor, "".join(sorted(letters | {c.upper() for c in letters if len(c.upper()) == 1}))


def learn_ciphers(words: DataFrame, rounds: int = 8, most_words: int = 50_000) -> DataFrame:
    """(source, word, swap, reading) of (source, word, n): the words that expectation-maximisation finds garbled.

    The posterior of a word's readings is its prior share among the swaps of its source, times how likely each symbol
    stands for its letter there, times the bigrams of the reading. The two former are learned per source. A word whose best
    reading isn't the literal one is garbled; with swap "lost" it can't be restored.

    The words of a source are learned from together; those of a source with more than `most_words` distinct ones are dealt by hash to as many
    groups of up to so many, each learning by itself: enough for shares of swaps, and no task gets more, whatever a source holds.
    """
    spark = words.sparkSession
    by_word = words.groupBy("word").agg(F.sum("n").alias("n"))
    broken = F.pandas_udf(lambda w: w.map(looks_broken), "boolean")
    bigrams, floor, alphabet = learn_letters(by_word.where(~broken("word")))
    model = spark.sparkContext.broadcast((bigrams, floor, alphabet))

    def propose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(*model.value)
        for frame in frames:
            rows = [(w, *r) for w in frame["word"] if len(found := decoder.readings(w)) > 1 for r in found]
            yield pd.DataFrame(rows, columns=["word", "swap", "reading", "score"])

    proposed = by_word.select("word").mapInPandas(propose, "word string, swap string, reading string, score double")

    def maximise(frame: pd.DataFrame) -> pd.DataFrame:
        readings = list(zip(frame["word"], frame["swap"], frame["reading"], frame["score"], frame["n"]))
        groups: dict[str, list[int]] = {}
        for i, r in enumerate(readings):
            groups.setdefault(r[0], []).append(i)
        symbols = [[c for c in r[0] if c > "\x7f" or c == "?"] for r in readings]
        prior = {s: 0.02 for s in set(frame["swap"])} | {LITERAL: 0.9, LOST: 0.9}
        stands = [0.0] * len(readings)  # log probability that the word's symbols stand for what the reading says
        for _ in range(rounds):
            share: dict[str, float] = dict.fromkeys(prior, 0.01)
            mapping: dict[tuple[str, str], float] = {}
            total: dict[str, float] = {}
            posterior = [0.0] * len(readings)
            for members in groups.values():
                logs = [math.log(prior[readings[i][1]]) + stands[i] + readings[i][3] for i in members]
                top = max(logs)
                weights = [math.exp(x - top) for x in logs]
                for i, w in zip(members, weights):
                    posterior[i] = w / sum(weights)
                    n = posterior[i] * readings[i][4]
                    share[readings[i][1]] += n
                    for c in symbols[i]:
                        mapping[c, readings[i][1]] = mapping.get((c, readings[i][1]), 0.0) + n
                        total[c] = total.get(c, 0.0) + n
            everything = sum(share.values())
            prior = {s: max(n / everything, 1e-4) for s, n in share.items()}
            prior[LITERAL] = max(prior[LITERAL], 0.05)
            prior[LOST] = max(prior.get(LOST, 0), 0.9)
            stands = [sum(math.log((mapping.get((c, r[1]), 0.0) + 0.05) / (total[c] + 0.5)) for c in cs) / max(1, len(cs)) for r, cs in zip(readings, symbols)]
        best = []
        for word, members in groups.items():
            i = max(members, key=lambda i: (math.log(prior[readings[i][1]]) + stands[i] + readings[i][3], readings[i][1] == LOST))
            if readings[i][1] != LITERAL:
                best.append((frame["source"].iloc[0], word, readings[i][1], readings[i][2]))
        return pd.DataFrame(best, columns=["source", "word", "swap", "reading"])

    groups = words.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(most_words)).cast("int").alias("groups")).where("groups > 1")
    salt = F.pmod(F.xxhash64("word"), F.coalesce("groups", F.lit(1)))
    dealt = words.join(proposed, "word").join(groups, "source", "left").withColumn("group", salt)
    return dealt.groupBy("source", "group").applyInPandas(maximise, "source string, word string, swap string, reading string")


def count_words(texts: DataFrame) -> DataFrame:
    """(source, word, n): the distinct words that may be garbled; partial counts before the shuffle."""
    words = texts.where(F.col("text").rlike(SUSPECT)).select("source", F.explode(matching_words("text", SUSPECT)).alias("word"))
    return words.groupBy("source", "word").agg(F.count(F.lit(1)).alias("n"))


def find_garbled(tables: Tables) -> DataFrame:
    """(table_name, row_id): the rows of several tables that hold garbled text.

    Null and empty texts, and texts of ASCII characters only, are never found; a null source is a source of its own. Rows with
    the same ident give one row. Texts are searched whole. Further columns are ignored.
    """
    texts = one_relation(tables)
    return rows_with_words(texts, SUSPECT, learn_ciphers(cut_lineage(count_words(texts))), ["source", "word"])


def restore_garbled(tables: Tables) -> DataFrame:
    """(table_name, row_id, text): the affected rows with their words replaced by the readings found; what is lost stays.
    Words are judged by themselves: one of a single letter stays where that letter is about as likely as its reading.

    Rows with the same ident and text give one row.
    """
    texts = one_relation(tables)
    return replace_words(texts, SUSPECT, learn_ciphers(cut_lineage(count_words(texts))), ["source", "word"], "reading")
