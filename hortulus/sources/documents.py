"""Readers of documents: files, plain or XHTML content, lines; encodings; splitting of run-together lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hortulus.functions.text import name_key, preprocess_line, split_lines, strip, tokens_of
from hortulus.operators.match import sized, starts_lower

LINE = "line_nr int, page int, raw string"


def clean_line(text: Column) -> Column:
    """Tabs to four blanks, stripped."""
    return strip(F.replace(text, F.lit("\t"), F.lit("    ")))


# Single-byte pages that are tried, the likelier first.
GUESSED_PAGES = ("cp1252", "cp1250", "cp1251", "koi8-r", "cp866", "cp850", "mac_roman", "iso8859-7")


def _plausibility(text: str) -> float:
    """How much the characters beyond ASCII look like letters in words: small letters beside letters count, signs and capitals
    within words count against, as do two scripts in one word."""
    score, before = 0.0, " "
    for c in f"{text} ":
        if c > "\x7f":
            if not c.isalpha():
                score -= 2.0 if before.isalpha() or "\x80" <= c <= "\x9f" or "\u2500" <= c <= "\u25a0" else 0.5
            elif c.islower():
                score += 1.0
            else:
                score -= 1.5 if before.islower() else 0.2
            if c.isalpha() and before.isalpha():
                if (c >= "\u0370") != (before >= "\u0370"):
                    score -= 2.0
                elif "\x7f" < before < "\u0370":  # accented letters seldom stand side by side
                    score -= 1.5
        elif c.isalpha() and before > "\u0370" and before.isalpha():
            score -= 2.0
        before = c
    return score


def guess_encoding(data: bytes) -> str:
    """By mark, else UTF-8 if the bytes are valid as such, else UTF-16 if every other byte is zero, else the single-byte page whose
    letters look most like words; of equal ones the first of GUESSED_PAGES."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if data.startswith(mark):
            return name
    for zeros, name in ((data[1::2], "utf-16-le"), (data[::2], "utf-16-be")):
        if len(data) > 3 and zeros.count(0) > 0.6 * len(zeros):
            return name
    try:
        data.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        return max(GUESSED_PAGES, key=lambda page: (_plausibility(data.decode(page, "replace")), -GUESSED_PAGES.index(page)))


def decode(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else b.decode(guess_encoding(b), "replace"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, filename, text): the .txt and .json files under a path, suffix in any case, decoded by their own encoding."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.lower("path").rlike("\\.(txt|json)$"))
    to_text = F.pandas_udf(decode, "string")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), to_text("content").alias("text"))


def _xhtml_lines(content: str) -> list[tuple[int, int, str]] | None:
    """(line_nr, page, text) of the paragraphs; each div begins a page, the first being 2; None if it is no XML."""
    from xml.etree import ElementTree

    try:
        root = ElementTree.fromstring(content)
    except ElementTree.ParseError:
        return None
    space = root.tag.replace("}html", "}") if "}" in root.tag else ""
    lines, page = [], 1
    for node in root.iter():
        if node.tag == f"{space}div":
            page += 1
        elif node.tag == f"{space}p" and node.text:
            lines += [(len(lines) + 1 + k, page, t.replace("\t", "    ").strip()) for k, t in enumerate(node.text.splitlines())]
    return lines


def content_lines(files: DataFrame, ident: str, content: str) -> DataFrame:
    """(ident, line_nr, page, raw): XHTML paragraphs numbered from 1, or the lines of plain content from 0 with page 0."""
    looks = F.col(content).rlike("^\\s*<")
    plain = files.select(ident, F.posexplode(split_lines(F.col(content))).alias("line_nr", "t"), F.lit(False).alias("x")).join(
        files.where(looks).select(ident).distinct(), ident, "left_anti"
    )
    schema = files.select(ident).schema[0].dataType.simpleString()

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for i, text in zip(frame[ident], frame[content]):
                found = _xhtml_lines(text)
                if found is None:
                    found = [(n, 0, t.replace("\t", "    ").strip()) for n, t in enumerate(text.splitlines())]
                rows += [(i, *f) for f in found]
            yield pd.DataFrame(rows, columns=[ident, "line_nr", "page", "raw"])

    marked = files.where(looks).select(ident, content).mapInPandas(parse, f"{ident} {schema}, {LINE}")
    return marked.unionByName(plain.select(ident, "line_nr", F.lit(0).alias("page"), clean_line(F.col("t")).alias("raw")))


def read_binary(spark: SparkSession, path: str, parser: Callable[[bytes], str], suffixes: tuple[str, ...] = ("pdf",)) -> DataFrame:
    """(path, filename, text, error) of files that need a parser of their own (PDF and the like): `parser` gives the text or XHTML of a file's
    bytes; a file that it fails on has a null text and the error."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, errors = [], []
            for data in frame["content"]:
                try:
                    texts.append(parser(bytes(data)))
                    errors.append(None)
                except Exception as error:  # one bad document must not stop the others
                    texts.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield pd.DataFrame({"path": frame["path"], "text": texts, "error": errors})

    files = with_suffix(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path), "path", suffixes)
    return files.select("path", "content").mapInPandas(parse, "path string, text string, error string").withColumn("filename", F.element_at(F.split("path", "/"), -1))


def with_suffix(files: DataFrame, path: str, suffixes: tuple[str, ...]) -> DataFrame:
    """The files whose suffix, in any case, is one of `suffixes` (without dots)."""
    return files.where(F.lower(F.regexp_extract(path, "\\.([^./]*)$", 1)).isin(*[s.lower() for s in suffixes]))


def json_documents(documents: DataFrame) -> DataFrame:
    """(path, filename, content) of read JSON envelopes; a document without content gives no row."""
    return documents.where(F.lower("filename").endswith(".json")).select("path", "filename", F.get_json_object("text", "$.document.content").alias("content")).where("content IS NOT NULL")


def document_states(documents: DataFrame) -> DataFrame:
    """(path, state) of read documents: failed (no JSON, or nothing that could be decoded), empty or read. Failed ones give no lines and stop
    nothing."""
    is_json = F.lower("filename").endswith(".json")
    broken = F.col("text").isNull() | (is_json & F.expr("try_parse_json(text)").isNull())
    content = F.when(is_json, F.get_json_object("text", "$.document.content")).otherwise(F.col("text"))
    return documents.select("path", F.when(broken, "failed").when(F.coalesce(F.length(content), F.lit(0)) == 0, "empty").otherwise("read").alias("state"))


def document_lines(documents: DataFrame) -> DataFrame:
    """(path, filename, line_nr, page, raw) of all read documents."""
    plain = documents.where(F.lower("filename").endswith(".txt")).select("path", F.posexplode(split_lines(F.col("text"))).alias("line_nr", "raw"))
    lines = plain.select("path", "line_nr", F.lit(0).alias("page"), "raw").unionByName(content_lines(json_documents(documents), "path", "content"))
    return lines.join(documents.select("path", "filename"), "path")


def split_on_genera(lines: DataFrame, ident: str, raw: str, genera: DataFrame) -> DataFrame:
    """(ident, part, raw): lines with two or more genera cut before each but the first; other lines as they are.

    Each genus, from the last to the first, cuts at its last occurrence in what is left of the line.
    """
    pre = lines.select(ident, F.col(raw).alias("raw"), preprocess_line(F.col(raw)).alias("pre"))
    tokens = pre.select(ident, "pre", F.posexplode(tokens_of(F.col("pre"))).alias("i", "token")).withColumn("key", name_key(F.col("token")))
    found = tokens.where(~starts_lower(F.col("token"))).join(sized(genera.select("key").distinct()), "key", "left_semi")
    listed = found.groupBy(ident, "pre").agg(F.sort_array(F.collect_list(F.struct("i", "token")), asc=False).alias("g"), F.count(F.lit(1)).alias("n")).where("n > 1")
    start = F.struct(F.col("pre").alias("left"), F.array().cast("array<string>").alias("parts"))

    def cut(state: Column, genus: Column) -> Column:
        left = state["left"]
        # the last occurrence, found from the end
        at = F.length(left) - F.instr(F.reverse(left), F.reverse(genus["token"])) - F.length(genus["token"]) + 2
        gone = F.instr(left, genus["token"]) == 0
        return F.struct(
            F.when(gone, F.substring(left, F.lit(1), F.length(left) - 1)).otherwise(F.substring(left, F.lit(1), at - 1)).alias("left"),
            F.concat(F.array(F.when(gone, F.substring(left, F.length(left), F.lit(1))).otherwise(F.substring(left, at, F.length(left)))), state["parts"]).alias("parts"),
        )

    folded = listed.withColumn("s", F.aggregate("g", start, cut))
    parts = F.concat(F.array(F.concat(F.col("s.left"), F.get("s.parts", F.lit(0)))), F.slice("s.parts", F.lit(2), F.size("s.parts")))
    cuts = folded.select(ident, F.posexplode(parts).alias("part", "raw"))
    rest = lines.select(ident, F.col(raw).alias("raw")).join(listed.select(ident), ident, "left_anti")
    return cuts.unionByName(rest.select(ident, F.lit(0).alias("part"), "raw"))
