import unicodedata

import pytest
from pyspark.sql import functions as F

from hortulus.llm import encoding, linking, lookalike, ocr

LINE = "line_id long, file_id long, garden_code string, page int, line_nr int, raw_line string"


def lines(spark, texts, **extra):
    df = spark.createDataFrame([(i, 1, "G", 1, i, t) for i, t in enumerate(texts)], LINE)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def of(df):
    return {"document_lines": (df, "line_id", "raw_line", "garden_code")}


# ---------------------------------------------------------------- encoding


CLEAN = ["Größe für Gärten", "Bölkek. & Dürer", "récolté en forêt près de Médée", "Höhe über Nähe", "São João não é", "Сухой склон у озера", "Семена собраны около озера", "Kjæmann Årstad’s"] * 40
BROKEN = {
    "utf-8>cp1252": "Bölkek. für Médée".encode().decode("cp1252"),
    "utf-8>cp437": "Größe".encode().decode("cp437"),
    "utf-8>mac_roman": "forêt près".encode().decode("mac_roman"),
    "cp1252>cp437": "Bölkek. Höhe".encode("cp1252").decode("cp437"),
    "cp1251>koi8-r": "Сухой склон у озера".encode("cp1251").decode("koi8-r"),
    "lost": "B�lkek.",
}


def test_garbled_lines_are_found_and_restored(spark):
    texts = [*CLEAN, *BROKEN.values(), "plain ASCII", "", None, "CÃOZINHA", "x" * 100_000]
    df = lines(spark, texts, word=1, source="clash", reading=None)
    expected = {len(CLEAN) + i for i in range(len(BROKEN))}
    assert {r.row_id for r in encoding.find_garbled(of(df)).collect()} == expected
    restored = {r.row_id: r.text for r in encoding.restore_garbled(of(df)).collect()}
    assert restored[len(CLEAN)] == "Bölkek. für Médée" and restored[len(CLEAN) + 1] == "Größe" and restored[len(CLEAN) + 4].split(" ")[:2] + restored[len(CLEAN) + 4].split(" ")[3:] == "Сухой склон озера".split(" ")  # a lone letter may stay


def test_garbled_edge_cases(spark):
    assert encoding.find_garbled(of(lines(spark, []))).count() == 0
    assert encoding.find_garbled(of(lines(spark, [None, "", "a"]))).count() == 0
    assert encoding.restore_garbled(of(lines(spark, ["a"]))).count() == 0


# ---------------------------------------------------------------- look-alikes


@pytest.mark.parametrize(
    "text, unified",
    [
        ("Ｒｏｓａ ａｌｂａ", "Rosa alba"),
        ("Ro​sa al﻿ba", "Rosa alba"),
        ("Rosa alba L.", "Rosa alba L."),
        ("Rоsa аlba", "Rosa alba"),
        ("Μölers.", "Mölers."),
        (unicodedata.normalize("NFD", "Désmé Ångström"), "Désmé Ångström"),
        ("коллекция с oзером", "коллекция с озером"),
        ("ﬂora", "flora"),
        ("ạ́", "ạ́"),
        ("ạ́", "ạ́"),
    ],
)
def test_unified(spark, text, unified):
    assert [r.text for r in lookalike.unify_lookalikes(of(lines(spark, [text]))).collect()] == [unified]


@pytest.mark.parametrize("text", [None, "", "plain", "Désmé", "sem̄. rec. n̄.", "Сухой склон", "(α) ½ № ² ’Alba‘ — ×", "KjГ¦ek", "Ã  la", "x" * 100_000, "νησος"])
def test_not_affected(spark, text):
    assert lookalike.find_lookalikes(of(lines(spark, [text], pos=1, ch="x"))).count() == 0


def test_invisible_only_and_empty_table(spark):
    assert [r.text for r in lookalike.unify_lookalikes(of(lines(spark, ["a ​ b"]))).collect()] == ["a  b"]
    assert lookalike.find_lookalikes(of(lines(spark, []))).count() == 0


# ---------------------------------------------------------------- linking


REFERENCE = [(1, "Rosa alba"), (2, "Rosa rubra"), (3, "Rosa rubra var. nana"), (4, "Viola palustris"), (5, "Viola × montana"), (6, "Lilium montanum"), (7, "Salix repens-longa")]
VALUES = {
    "rosa ALBA": 1, "alba, Rosa": 1, "R. alba L.": 1, "Rosa a1ba": 1, "Rosa albba": 1, "Rosa": -1, "Rosa sp.": -1, "Rosa nigra": -1, "Rosa rubra variet. nana": 3, "Rosa rubra f. nana": -1,
    "cf. Viola palus- tris": 4, "Viola montana": 5, "no. 12 Viola pa​lustris (hort.)": 4, "Ｖｉｏｌａ palustris": 4, "Salix repenslonga Mill.": 7, "???": -1, " ": -1, "x" * 5000: -1, "Lilium palustris": -1,
}


def test_links(spark):
    reference = spark.createDataFrame(REFERENCE, "ref_id long, canonical_name string")
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)] + [(98, None), (99, ""), (1000, "rosa ALBA")], "entry_id long, v string").withColumn("ref_id", F.lit(3)).withColumn("text", F.lit(""))
    got = {r.entry_id: r.ref_id for r in linking.link_rows(rows, "entry_id", "v", reference).collect()}
    assert got == {i: r for i, r in enumerate(VALUES.values())} | {1000: 1}


def test_link_edge_cases(spark):
    reference = spark.createDataFrame(REFERENCE, "ref_id long, canonical_name string")
    rows = spark.createDataFrame([(1, "Rosa alba")], "entry_id long, v string")
    assert linking.link_rows(rows.limit(0), "entry_id", "v", reference).count() == 0
    assert [tuple(r) for r in linking.link_rows(rows, "entry_id", "v", reference.limit(0)).collect()] == [(1, -1)]
    doubled = reference.unionByName(spark.createDataFrame([(9, "rosa ALBA"), (None, "Rosa alba"), (10, None)], "ref_id long, canonical_name string"))
    assert [tuple(r) for r in linking.link_rows(rows, "entry_id", "v", doubled).collect()] == [(1, 1)]
    with pytest.raises(ValueError):
        linking.link_rows(rows, "entry_id", "v", reference, max_list=3)


def test_link_behind_many_words(spark):
    reference = spark.createDataFrame(REFERENCE, "ref_id long, canonical_name string")
    value = "lecta prope oppidum vetus in ripa fluminis Rosa rubra"
    rows = spark.createDataFrame([(1, value)], "entry_id long, v string")
    assert [tuple(r) for r in linking.link_rows(rows, "entry_id", "v", reference).collect()] == [(1, 2)]


# ---------------------------------------------------------------- scans


@pytest.mark.parametrize(
    "printed, read, is_one",
    [
        ("ludventodes", "liidventocles", True), ("tomiflora", "tomifl0ra", True), ("belvimia", "belvirnia", True), ("turbifolia", "turbifoila", False), ("ovensis", "ovensys", False),
        ("rosa", "rosa", False), ("pauculosum", "pauculosiim", True), ("serrifolia", "sernfolia", True), ("alba", "albba", False), ("harnelanthus", "hame1anthus", True), ("", "", False),
    ],
)
def test_misreadings(spark, printed, read, is_one):
    assert ocr.is_misreading(printed, read) is is_one
    if is_one:
        a, b = spark.createDataFrame([(printed,), (read,)], "w string").select(ocr.glyph_skeleton(F.col("w"))).collect()
        assert a == b


def scans(spark, rows, contents=(), entries=()):
    page_lines = spark.createDataFrame([(i, 1, "G", p, n, t) for i, (p, n, t) in enumerate(rows)], LINE).withColumn("row_id", F.lit(0)).withColumn("words", F.lit(""))
    files = spark.createDataFrame(list(enumerate(contents)), "file_id long, content string").withColumn("garden_code", F.lit("G"))
    names = spark.createDataFrame(list(enumerate(entries)), "entry_id long, extracted_name string").withColumn("garden_code", F.lit("G"))
    tables = {"document_lines": (page_lines, "line_id", "raw_line", "garden_code"), "seedlist_files": (files, "file_id", "content", "garden_code"), "list_entries": (names, "entry_id", "extracted_name", "garden_code")}
    words = spark.createDataFrame([("Rosa alba", True), ("Viola palustris", True), ("Viola turbiflora", True)], "name string, trusted boolean")
    return (tables, "document_lines", "seedlist_files", "list_entries", words)


def test_noise_is_found(spark):
    rows = [(1, 0, "Index seminum"), (1, 1, "Rosa a1ba"), (1, 2, "the seeds were gat-"), (1, 3, "hered; Samen-"), (1, 4, "und Pflanzen, 1886-"), (1, 5, "XX-0-GAR-"), (1, 6, "17 Rosa alba"), (1, 7, "— 1 —"), (1, 8, None), (1, 9, "1907"), (1, 10, "")]
    for p in range(2, 7):
        rows += [(p, p * 20, f"{p} Delectus seminum 19{p}0"), (p, p * 20 + 1, "Viola palustris"), (p, p * 20 + 2, "Rosa albba"), (p, p * 20 + 3, "Vio-"), (p, p * 20 + 4, "la palustris"), (p, p * 20 + 5, f"[{p}]")]
    content = "<html><body><div><p>Title</p><p>Rosa 0lba</p><p>a bro¬</p><p>ken &amp; word</p><p>pag. 4</p></div></body></html>"
    args = scans(spark, rows, [content, None, "", "Rosa alba\nVioIa palustris"], ["Viola palu- stris", "Viola turbi-flora", "Rosa alba-nigra", None, "", "Viola palustr1s", "x" * 50_000])
    got: dict = {}
    for r in ocr.find_noise(*args).collect():
        got.setdefault((r.table_name, r.kind), set()).add(r.row_id)
    first = [i for i, r in enumerate(rows) if r[0] > 1 and r[1] % 20 == 0]
    assert got["document_lines", "header"] == set(first)
    assert got["document_lines", "page_number"] == {7} | {i + 5 for i in first}
    assert got["document_lines", "hyphen"] == {2} | {i + 3 for i in first}
    assert got["document_lines", "misread"] == {1}
    assert got["seedlist_files", "hyphen"] == {0} and got["seedlist_files", "page_number"] == {0} and got["seedlist_files", "misread"] == {3}
    assert got["list_entries", "hyphen"] == {0, 1} and got["list_entries", "misread"] == {5}
    pages = {(r.file, r.page): r.text for r in ocr.repair_pages(*args).collect()}
    assert pages["l1", 2] == "Viola palustris Rosa albba Viola palustris"
    assert pages["c0", None] == "Title Rosa 0lba a broken & word"
    assert pages["l1", 1].startswith("Index seminum Rosa alba the seeds were gathered ;")


def test_no_rows(spark):
    assert ocr.find_noise(*scans(spark, [])).count() == 0
    assert ocr.repair_pages(*scans(spark, [])).count() == 0


def test_headers_of_a_small_garden(spark):
    # 4,000 pages of another garden, so that three are less than 0.1 % of all; three files of G, a header on one page of each
    tables, *names = scans(spark, [])
    rows = [(p, 9, "B", p, p * 10, f"{p} Delectus seminum") for p in range(2, 4002)]
    rows += [(5000 + 10 * f + i, 100 + f, "G", p, i, t) for f in range(3) for i, (p, t) in enumerate([(1, "Index"), (1, "Rosa alba"), (2, f"Hort. Braskmond {f}"), (2, "Viola palustris")])]
    contents = "<html><body><div><p>Index</p><p>Rosa alba</p></div><div><p>Solö Garden 2</p><p>Viola palustris</p></div><div><p>3</p><p>Solö Garden</p><p>Rosa alba</p></div></body></html>"
    tables["document_lines"] = (spark.createDataFrame(rows, LINE), *tables["document_lines"][1:])
    tables["seedlist_files"] = (spark.createDataFrame([(1, contents, "H")], "file_id long, content string, garden_code string"), *tables["seedlist_files"][1:])
    found = {(r.table_name, r.row_id) for r in ocr.find_noise(tables, *names).where("kind = 'header'").collect()}
    assert {r for t, r in found if r >= 5000} == {5002, 5012, 5022} and ("seedlist_files", 1) in found
    assert len(found) == 4004


def test_misread_words_far_behind_in_a_line(spark):
    far = "which came from the northern slope with others, inter quos Viola palustr1s"
    args = scans(spark, [(1, 0, "Index"), (1, 1, far)], [f"Index and {far}"])
    found = {(r.table_name, r.row_id) for r in ocr.find_noise(*args).where("kind = 'misread'").collect()}
    assert found == {("document_lines", 1), ("seedlist_files", 0)}
    assert [r.text for r in ocr.repair_pages(*args).where("page = 1").collect()] == ["Index " + far.replace("1", "i")]


def test_page_numbers_of_three_digits(spark):
    # an offset of 97: 99, 100, 101; 426 stands alone, and 750 in a file that gives no other number
    rows = [(p, 10 * p + i, t) for p in (2, 3, 4) for i, t in enumerate([str(97 + p), ("Rosa", "Viola", "Salix")[p - 2], "a", "b", "c", "d", "e"])] + [(5, 50, "426")]
    content = ["Rosa\n99\nalba\n100\nrubra\n101", "Rosa\n750\nalba"]
    found = {(r.table_name, r.row_id) for r in ocr.find_noise(*scans(spark, rows, content)).where("kind = 'page_number'").collect()}
    assert found == {("document_lines", 0), ("document_lines", 7), ("document_lines", 14), ("seedlist_files", 0)}
    pages = {(r.file, r.page): r.text for r in ocr.repair_pages(*scans(spark, rows, content)).collect()}
    assert pages["l1", 4] == "Salix a b c d e" and pages["l1", 5] == "426"
    assert pages["c0", None] == "Rosa alba rubra" and pages["c1", None] == "Rosa 750 alba"


# ---------------------------------------------------------------- cases of the second round


def test_link_of_words_run_together(spark):
    reference = spark.createDataFrame(REFERENCE, "ref_id long, canonical_name string")
    values = {"Rosaalba": 1, "ROSAALBBA": 1, "Rosarubra var. nana": 3, "alba": -1, "rosaviola": -1}
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "entry_id long, v string")
    assert {r.entry_id: r.ref_id for r in linking.link_rows(rows, "entry_id", "v", reference).collect()} == dict(enumerate(values.values()))


@pytest.mark.parametrize("value, names, ref_id", [("R. alba", ["Rosa alba", "Ruta alba"], -1), ("Rosa albu", ["Rosa alba", "Rosa albi"], -1), ("Rosa alba", ["Rosa alba", "Rosa albi"], 1)])
def test_margin_leaves_ties_open(spark, value, names, ref_id):
    reference = spark.createDataFrame(list(enumerate(names, 1)), "ref_id long, canonical_name string")
    assert [r.ref_id for r in linking.link_rows(spark.createDataFrame([(1, value)], "entry_id long, v string"), "entry_id", "v", reference).collect()] == [ref_id]


@pytest.mark.parametrize("least", [0.1, 0.5])
def test_gram_index_equals_brute_force(spark, small, least):
    from math import log1p, sqrt

    def words(path, column, most):
        each = spark.read.parquet(f"{small}/{path}.parquet").select(F.explode(F.split(linking.plain_value(F.col(column)), " ")).alias("word"))
        return sorted({r.word for r in each.distinct().collect()} - {""})[:most]

    listed, asked = words("reference_names", "canonical_name", 300), words("list_entries", "extracted_name", 900)
    asked = sorted(set(asked) - set(listed))
    grams = lambda w: {f"^{w}$"[i : i + 3] for i in range(max(len(w), 1))}
    df: dict = {}
    for w in listed:
        for g in grams(w):
            df[g] = df.get(g, 0) + 1
    weight = lambda g: log1p(len(listed) / df[g]) if g in df else log1p(2 * len(listed))
    edits = lambda a, b: min_edits(a, b)
    want = {}
    for a in asked:
        for b in listed:
            if abs(len(a) - len(b)) > max(2, int(len(b) * 0.25)) or edits(a, b) > max(2, int(len(b) * 0.25)):
                continue
            dot = sum(weight(g) ** 2 for g in grams(a) & grams(b))
            cosine = dot / sqrt(sum(weight(g) ** 2 for g in grams(a)) * sum(weight(g) ** 2 for g in grams(b)))
            if round(cosine, 6) >= least:
                want[a, b] = round(cosine, 4)
    table = lambda ws: spark.createDataFrame([(w,) for w in ws], "word string")
    got = {(r.word, r.ref_word): round(r.cosine, 4) for r in linking.alike_words(table(asked), table(listed), least, 0.25).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-4 for k in want) and want


def min_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_each_remnant_of_garbling_stays_as_it_is(spark):
    words = spark.createDataFrame([("Ã xÃ­ａ",), ("﷐ａ",), ("ａ",)], "word string")
    assert {r.word: r.unified for r in lookalike.unify_words(words).collect()} == {"Ã xÃ­ａ": "Ã xÃ­a", "﷐ａ": "﷐a", "ａ": "a"}


def test_words_of_a_large_source_are_dealt_to_groups(spark):
    texts = [*CLEAN, *BROKEN.values()]
    words = encoding.count_words(encoding.one_relation(of(lines(spark, texts)))).cache()
    whole, dealt = ({(r.word, r.reading) for r in encoding.learn_ciphers(words, most_words=m).collect()} for m in (50_000, 8))
    assert whole and len(whole & dealt) >= 0.7 * len(whole)


def test_a_word_as_frequent_as_the_printed_one_needs_its_contexts(spark):
    def found(texts):
        rows = spark.createDataFrame([("t", i, "f", i, t) for i, t in enumerate(texts)], "table_name string, row_id long, file string, line_nr int, text string")
        words = spark.createDataFrame([("rosa", 1), ("alba", 1), ("viola", 1), ("palustris", 1)], "word string, n long")
        names = spark.createDataFrame([("Rosa alba",), ("Viola palustris",)], "text string")
        return {r.word for r in ocr.misread_words(rows, names, words).collect()}

    assert found(["Rosa alba"] * 4 + ["Rosa aiba"]) == {"aiba"}
    assert found(["Rosa alba"] * 4 + ["near the town aiba with walls"] * 9) == set()  # a word of its own
    assert found(["Rosa alba"] * 4 + ["Rosa aiba"] * 6) == {"aiba"}  # often misread, where the printed one stands
    assert found(["", "x" * 100_000]) == set()


def test_lines_of_files_are_parsed_once(spark):
    tables = scans(spark, [(1, 0, "Index")], ["<html><body><div><p>a &amp; b</p><p>c</p></div></body></html>"])[0]
    got = ocr.page_lines(tables, "document_lines", "seedlist_files")
    assert "regexp_extract_all" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert [r.text for r in got.where("table_name = 'seedlist_files'").orderBy("line_nr").collect()] == ["a & b", "c"]


def test_neighbours_of_suspects_carry_no_array(spark):
    rows = spark.createDataFrame([(1, "Rosa alba var. rubra f. plena"), (2, "alba"), (3, ""), (4, None)], "row_id long, text string")
    suspects = spark.createDataFrame([("alba",), ("plena",)], "word string")
    got = ocr.with_neighbours(rows, suspects)
    exploded = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate" in line]
    assert len(exploded) == 1 and "__words" not in exploded[0]
    assert sorted(map(str, got.collect())) == sorted(map(str, ocr.with_neighbours(rows).join(suspects, "word").select(*got.columns).collect()))
    assert {(r.row_id, r.word, r.before, r.behind) for r in got.collect()} == {(1, "alba", "rosa", "rubra"), (1, "plena", "rubra", None), (2, "alba", None, None)}


def test_every_form_of_the_break_sign_in_a_name(spark):
    signs = [*ocr.HYPHENS, *ocr.broken_hyphens()]
    texts = [f"Viola palu{sign} stris" for sign in signs] + ["Viola palu-stris", "Viola palu‐stris", "Viola palu¬stris", "Viola palu=stris"]
    plain = ["Viola palustris", "Rosa alba-nigra", "Rosa × alba", "Viola palu -stris", "", None]
    names = spark.createDataFrame([("t", i, t) for i, t in enumerate(texts + plain)], "table_name string, row_id long, text string")
    words = spark.createDataFrame([("palustris", 1)], "word string, n long")
    assert {r.row_id for r in ocr.broken_names(names, words).collect()} == set(range(len(texts)))
