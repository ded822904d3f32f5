"""Splitting texts above a size limit at natural boundaries, with overlap, sizes in tokens of a public tokenizer."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hortulus.llm.bpe import list_array, map_tokens

# One letter per token tells what lies behind it: paragraph, line, sentence, clause, word, change of character kind, none,
# or (u) the middle of a character, where nothing may be cut.
STRENGTHS = "PLSCWXMu"
SEGMENT = 4096


# White space, line ends, and marks that end sentences and clauses.
BLANKS = (9, 11, 12, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SENTENCE_ENDS, CLAUSE_ENDS = ".!?…。", ",;:–—"
SPACE, LINE, WORD, SENTENCE, CLAUSE = 1, 2, 4, 8, 16


@functools.cache
def character_kinds() -> np.ndarray:
    """The kinds of each code point as bits."""
    kinds = np.zeros(0x110000, np.uint8)
    kinds[[c for c in range(0x110000) if chr(c).isalnum()]] = WORD
    kinds[list(BLANKS)] = SPACE
    kinds[[10, 13]] = SPACE | LINE
    kinds[[ord(c) for c in SENTENCE_ENDS]] = SENTENCE
    kinds[[ord(c) for c in CLAUSE_ENDS]] = CLAUSE
    return kinds


def boundary_letters(texts: list[str], offsets: np.ndarray, ids: np.ndarray, vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(letters, ends) of the tokens of all texts: the boundary letter behind each, and the number of characters of its text up to its end."""
    joined = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]  # of each text
    counts = np.diff(offsets)
    base = np.repeat(begins, counts)
    running = np.cumsum(vocabulary.leads[ids], dtype=np.int64)
    done = np.concatenate([[0], running])[offsets[:-1]]
    ends = running - np.repeat(done, counts)
    kinds = character_kinds()[joined]
    space = (kinds & SPACE) > 0
    newline = (kinds & LINE) > 0
    newline[:-1] &= ~((joined[:-1] == 13) & (joined[1:] == 10))
    behind = base + ends  # the character after each token; the one before is at behind - 1
    solid = np.maximum.accumulate(np.where(space, 0, np.arange(len(joined))))  # last character that is no space
    lines = np.cumsum(newline)
    before, after = space[behind - 1], space[behind]
    last = np.maximum(solid[behind - 1], base)
    breaks = np.where(before, lines[behind - 1] - lines[last], 0)
    mark, gap = kinds[last], before | after
    out = np.where((kinds[behind - 1] & WORD > 0) & (kinds[behind] & WORD > 0), ord("M"), ord("X")).astype(np.uint8)
    out[gap] = ord("W")
    out[gap & (mark & CLAUSE > 0)] = ord("C")
    out[gap & (mark & SENTENCE > 0)] = ord("S")
    out[breaks == 1] = ord("L")
    out[breaks > 1] = ord("P")
    out[:-1][vocabulary.continues[ids[1:]]] = ord("u")
    return out, ends


def _build(texts, offsets, ids, vocabulary):
    filled = [t or "" for t in texts]
    letters, ends = boundary_letters(filled, offsets, ids, vocabulary) if len(ids) else (np.zeros(0, np.uint8), np.zeros(0, np.int64))
    strings = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(letters.tobytes()))
    return [strings, list_array(offsets, ends)]


def piece_pattern(limit: int, overlap: int) -> str:
    """A regex over boundary letters: each match is the next piece's own tokens. Alternatives stand in order of strength;
    the stronger ones must fill half of the limit, then any length serves; the last falls back to any character's end."""

    def steps(most: int) -> str:
        half = most // 2
        strong = [f"[PLSCWXMu]{{{max(0, half - 1)},{most - 1}}}{s}" for s in "PLSC"]
        weak = [f"[PLSCWXMu]{{0,{most - 1}}}{s}" for s in ("[PLSCW]", "X", "[^u]")]
        return "|".join([f"[PLSCWXMu]{{1,{most}}}\\z", *strong, *weak, f"[PLSCWXMu]{{1,{most}}}"])

    return f"\\A(?:{steps(limit)})" if not overlap else f"\\A(?:{steps(limit)})|(?:{steps(limit - overlap)})"


def split_texts(df: DataFrame, limits: DataFrame, ident: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(limit_id, ident, piece_nr, start_char, n_tokens, overlap, piece) for each text above max_tokens of a row of `limits`.

    The text is tokenised once; a string with one boundary letter per token is made of it, and a regex with bounded
    quantifiers takes from that string the longest pieces that end at the strongest boundary. Each piece but the first
    starts overlap_tokens before the end of the one before (less by up to three tokens only where that would cut a character),
    and has max_tokens at most. Since no merge crosses a token's edge, a piece encodes to as many tokens as it was given.
    Texts within the limit, empty and null ones have no row. Every character of a text is in a piece. Repeated rows are split
    each; further columns are ignored. `limits` (limit_id, max_tokens, overlap_tokens) is small: its rows become literals of
    the plan (fewer than 1000, else ValueError); rows with nulls, max_tokens under 8 or overlap beyond half of it are refused.
    """
    settings = limits.select("limit_id", "max_tokens", "overlap_tokens").limit(1001).collect()
    if len(settings) > 1000:
        raise ValueError("more than 1000 size limits")
    for row in settings:
        if None in tuple(row) or row["max_tokens"] < 8 or not 0 <= row["overlap_tokens"] <= row["max_tokens"] // 2:
            raise ValueError(f"unusable size limit {row}")
    rows = df.where(F.col(text).isNotNull()).select(F.col(ident).alias("__id"), F.col(text).alias("__text"))
    fields = [T.StructField("__letters", T.StringType()), T.StructField("__ends", T.ArrayType(T.IntegerType()))]
    coded = map_tokens(rows, "__text", fields, _build, vocabulary)
    if not settings:
        return coded.where("false").select(
            F.lit(0).alias("limit_id"), F.col("__id").alias(ident), *[F.lit(0).alias(c) for c in ("piece_nr", "start_char", "n_tokens", "overlap")], F.col("__text").alias("piece")
        )
    made: Column = F.lit(None)
    for row in settings:
        limit, overlap = row["max_tokens"], row["overlap_tokens"]
        found = F.when(F.length("__letters") > limit, F.regexp_extract_all("__letters", F.lit(_whole(limit, overlap)), F.lit(0)))
        entry = F.struct(F.lit(row["limit_id"]).alias("limit_id"), F.lit(overlap).alias("overlap"), F.transform(found, F.length).alias("sizes"))
        made = F.array(entry) if row is settings[0] else F.concat(made, F.array(entry))
    # the regexes run where the letters are made; the texts of no use are dropped before the explode
    per_limit = coded.where(F.length("__letters") > min(r["max_tokens"] for r in settings)).withColumn("__l", F.explode(made)).where("__l.sizes IS NOT NULL")
    # running ends of the pieces, then (first token, last token) of each with lookback
    stops = F.aggregate(
        "__l.sizes", F.array(F.lit(0)), lambda acc, size: F.concat(acc, F.array(F.element_at(acc, -1) + size))
    )
    spans = per_limit.select(
        "__id",
        "__l.limit_id",
        "__l.overlap",
        "__ends",
        "__letters",
        F.regexp_extract_all("__text", F.lit(f"(?s).{{1,{SEGMENT}}}"), F.lit(0)).alias("__segments"),
        stops.alias("__stops"),
    ).select("*", F.posexplode(F.slice("__stops", F.lit(2), F.size("__stops") - 1)).alias("piece_nr", "stop"))
    back = F.greatest(F.element_at("__stops", F.col("piece_nr") + 1) - F.when(F.col("piece_nr") > 0, F.col("overlap")).otherwise(F.lit(0)), F.lit(0))
    spans = spans.withColumn("__back", back)
    blind = F.when(F.col("__back") > 0, F.length(F.regexp_extract(F.substring("__letters", F.col("__back"), F.lit(4)), "^u*", 0))).otherwise(F.lit(0))
    spans = spans.withColumn("start", F.col("__back") + blind)
    first = F.when(F.col("start") > 0, F.element_at("__ends", F.when(F.col("start") > 0, F.col("start")).otherwise(F.lit(1)))).otherwise(F.lit(0))
    spans = spans.withColumn("start_char", first).withColumn("__end_char", F.element_at("__ends", F.col("stop")))
    segment = F.floor(F.col("start_char") / SEGMENT).cast("int")
    last = F.floor((F.col("__end_char") - 1) / SEGMENT).cast("int")
    around = F.array_join(F.slice("__segments", segment + 1, last - segment + 1), "")
    piece = F.substring(around, F.col("start_char") - segment * SEGMENT + 1, F.col("__end_char") - F.col("start_char"))
    return spans.select(
        "limit_id",
        F.col("__id").alias(ident),
        F.col("piece_nr"),
        F.col("start_char").cast("int").alias("start_char"),
        (F.col("stop") - F.col("start")).alias("n_tokens"),
        F.when(F.col("piece_nr") > 0, F.element_at("__stops", F.col("piece_nr") + 1) - F.col("start")).otherwise(F.lit(0)).alias("overlap"),
        piece.alias("piece"),
    )


def _whole(limit: int, overlap: int) -> str:
    """piece_pattern() for extraction of all pieces: without overlap all have the same limit."""
    pattern = piece_pattern(limit, overlap)
    return pattern if overlap else pattern.removeprefix("\\A")
