import json

import pytest
from pyspark.sql import functions as F

from hortulus.functions import text as tx
from hortulus.operators import context, match, names, rows
from hortulus.operators.lookup import lookup
from hortulus.plans import extract as plan
from hortulus.sources import documents, sinks, taxonomies
from hortulus.streaming import extraction

NAMES = "ord long, canonical_name string, genus string, epithet string, infraspecific_epithet string, authorship string, taxon_rank string, source string, prio int"
ROWS = [
    (1, "Adiantum concinnum", "Adiantum", "concinnum", None, "Humb. & Bonpl. ex Willd.", "species", "WCVP", 1),
    (2, "Adianthum", "Adianthum", None, None, "L.", "genus", "WCVP", 1),
    (3, "Adiantum", "Adiantum", None, None, "L.", "genus", "WCVP", 1),
    (4, "Rosa", "Rosa", None, None, "L.", "genus", "WFO", 2),
    (5, "Rosa alba", "Rosa", "alba", None, "L.", "species", "WFO", 2),
    (6, "Rosa alba", "Rosa", "alba", None, "Mill.", "species", "GBIF", 4),
    (7, "Rosa alba subsp. nana", "Rosa", "alba", "nana", None, "subspecies", "WFO", 2),
    (8, "Rosa rubra", "Rosa", "rubra", None, "L.", "species", "WFO", 2),
    (9, "Rosa × hybrida", "Rosa", "hybrida", None, None, "species", "WFO", 2),
    (10, "Silene flos-jovis", "Silene", "flos-jovis", None, "(L.) Greuter & Burdet", "species", "WFO", 2),
    (11, "Lychnis flos-jovis", "Lychnis", "flos-jovis", None, "(L.) Desr.", "species", "WFO", 2),
    (12, "Rosaceae", "Rosaceae", None, None, None, "family", "WFO", 2),
    (13, "Rosa alba", "Rosa", "alba", None, "L.", "species", "GBIF", 4),
]


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame(ROWS, NAMES)


def lines(spark, texts, doc=1, name="TEBLI-2020-x.txt"):
    return spark.createDataFrame([(doc, i, t, name, "TEBLI", 2020) for i, t in enumerate(texts)], extraction.LINES)


def extracted(spark, known, texts, **options):
    return [r.asDict() for r in plan.extract(lines(spark, texts), known, plan.Options(**options)).orderBy("line").collect()]


def test_documented_fuzzy_line(spark, known):
    row = extracted(spark, known, ["13. Adianthum concinnum. H.B.K.p."], fuzzy=match.Fuzzy(threshold=0.8))[0]
    assert (row["extracted_name"], row["match_name"], row["match_score"]) == ("Adianthum concinnum", "Adiantum concinnum", 0.92)
    assert (row["genus_extracted_name"], row["genus_match_genus"], row["genus_match_score"]) == ("Adianthum", "Adianthum", 1.0)
    assert row["genera_match_score"] == pytest.approx(0.941176470588235)


def test_documented_lines_with_code_and_synonym(spark, known):
    row = extracted(spark, known, ["178 O Silene flos-jovis (L.) Greuter & Burdet ’Nana‘ [syn. Lychnis flos-jovis (L.) Desr.]", "XX-0-TEBLI-00857 [ex BG Debrecen, Hungary]"])[0]
    assert row["extracted_cultivar_form"] == "’Nana‘" and row["extracted_ipen"] == "XX-0-TEBLI-00857"
    assert row["extracted_metadata_next_lines"] == "[ex BG Debrecen, Hungary]"
    assert row["extracted_synonyms"] == "Lychnis flos-jovis (L.) Desr. [Lychnis flos-jovis]"
    assert (row["filename"], row["garden_code"], row["year"]) == ("TEBLI-2020-x.txt", "TEBLI", 2020)


def test_isolated_epithets(spark, known):
    found = extracted(spark, known, ["Rosa alba L.", "- rubra", "", "rubra"])
    assert [r["match_name"] for r in found] == ["Rosa alba", "Rosa rubra", "Rosa rubra"]


def test_code_over_two_lines(spark, known):
    found = extracted(spark, known, ["Rosa alba XX-0-TEB", "LI-00857 dry"])
    assert found[0]["extracted_ipen"] == "XX-0-TEBLI-00857" and not (found[0]["extracted_metadata_remnant"] or "").strip()
    assert found[0]["extracted_metadata_next_lines"] == "dry"


def test_legend(spark, known):
    found = extracted(spark, known, ["Rosa alba L. ♃ x", "♃ - perennial plants of the garden", "Rosa rubra"])
    assert found[0]["extracted_notes"] == "♃ - perennial plants of the garden" and found[1]["extracted_notes"] is None


def test_dictionaries(spark, known):
    made = plan.dictionaries(known)
    first = {r.key: r for r in made.canonical.collect()}
    assert "rosaceae" not in first and first["rosa alba"].source == "WFO"
    assert first["rosa alba"].authorships == [("L.", "WFO"), ("Mill.", "GBIF"), ("L.", "GBIF")]
    assert {r.key: r.source for r in made.epithets.collect()}["alba"] == "GBIF"  # the last one
    listed = made.canonical.where("key = 'rosa alba'").select(names.authorship_list(F.col("authorships"))).first()[0]
    assert listed == "L. [WFO]; Mill. [GBIF]"
    asked = spark.createDataFrame([("rosa alba",), ("rosa",), ("Rosa",), (None,)], "s string")
    assert {r.lookup for r in lookup(asked, "s", made).collect()} == {"rosa alba", "Rosa"}
    assert {r.lookup for r in lookup(asked, "s", made, "genus").collect()} == {"Rosa"}
    assert [r.canonical_name for r in lookup(spark.createDataFrame([("Rosa albba",)], "s string"), "s", made, fuzzy=True).collect()] == ["Rosa alba"]
    with pytest.raises(ValueError):
        lookup(asked, "s", made, "family")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_nearest_equals_brute_force(spark, small):
    keys = [r[0] for r in spark.read.parquet(f"{small}/reference_names.parquet").select(F.lower("canonical_name")).distinct().limit(150).collect()]
    asked = [r[0] for r in spark.read.parquet(f"{small}/list_entries.parquet").where("extracted_name <> ''").select("extracted_name").distinct().limit(120).collect()] + ["x"]
    table = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, ord long")
    got = {r.lookup: (r.distance, r.key) for r in match.nearest_names(spark.createDataFrame([(a,) for a in [*asked, None, ""]], "l string"), "l", table).collect()}
    assert got == {a: min((edits(a, k), i, k) for i, k in enumerate(keys))[::2] for a in asked}


def test_fuzzy_settings():
    for bad in ({"threshold": 0}, {"threshold": 1.1}, {"strategy": "x"}):
        with pytest.raises(ValueError):
            match.Fuzzy(**bad)


def test_candidates(spark):
    df = spark.createDataFrame([(1, 0, "Ab Rosa alba nana"), (1, 1, "a b c d e f g h i j rosa alba"), (1, 2, "averylongsingletoken"), (1, 3, "")], "doc long, line_nr int, raw string")
    got = {(r.line_nr, r.option, r.num_tokens, r["index"]) for r in match.fuzzy_candidates(df, ["doc", "line_nr"], "raw").collect()}
    assert got == {(0, "Rosa alba", 2, 3), (0, "Rosa alba nana", 3, 3), (0, "alba nana", 2, 8), (1, "rosa alba", 2, 20), (2, "averylongsingletoken", 1, 0)}


def test_last_look_ahead_is_trimmed(spark, known):
    texts = [x for i in range(5) for x in ["Rosa alba", *[f"note {i} {k}" for k in range(2 if i < 4 else 5)]]]
    found = plan.with_context(plan.recognise(lines(spark, texts), plan.dictionaries(known)))
    sizes = [len(r.meta_next) for r in found.where("has_name").orderBy("line_nr").collect()]
    assert sizes == [2, 2, 2, 2, 2]


def test_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "A-1900.txt").write_bytes("Größe\x0cRosa\r\n".encode("cp1252"))
    xhtml = '<html xmlns="http://www.w3.org/1999/xhtml"><body><div><p>one\ntwo\t</p></div><div><p>three<b>x</b></p><p/></div></body></html>'
    (tmp_path / "sub" / "B.JSON").write_text(json.dumps({"filename": "b", "document": {"content": xhtml}}))
    (tmp_path / "C.json").write_text(json.dumps({"document": {"content": "plain\n<b"}}))
    (tmp_path / "D.json").write_text("{}")
    (tmp_path / "E.pdf").write_text("x")
    got = sorted((r.filename, r.line_nr, r.page, r.raw) for r in documents.document_lines(documents.read_documents(spark, str(tmp_path))).collect())
    assert got == [("A-1900.txt", 0, 0, "Größe"), ("A-1900.txt", 1, 0, "Rosa"), ("B.JSON", 1, 2, "one"), ("B.JSON", 2, 2, "two"), ("B.JSON", 3, 3, "three"), ("C.json", 0, 0, "plain"), ("C.json", 1, 0, "<b")]
    assert documents.guess_encoding("Сухой склон".encode("cp1251")) == "cp1251"


def test_split_on_genera(spark):
    df = spark.createDataFrame([(1, "1 Rosa alba 2 Silene x Rosa nigra"), (2, "Rosa alba"), (3, "nothing")], "line_id long, raw string")
    genera = spark.createDataFrame([("rosa",), ("silene",)], "key string")
    got = sorted(tuple(r) for r in documents.split_on_genera(df, "line_id", "raw", genera).collect())
    assert got == [(1, 0, "1 Rosa alba 2 "), (1, 1, "Silene × "), (1, 2, "Rosa nigra"), (2, 0, "Rosa alba"), (3, 0, "nothing")]


def test_taxonomies(spark, tmp_path):
    path = tmp_path / "wcvp.csv"
    head = "|".join(taxonomies.SOURCES["WCVP"].columns)
    path.write_text(head + "\nRosa x alba|Rosa|alba||L.|Species\nRosa|Rosa||||Genus\nFoo|Foo||||unknown\n")
    got = sorted((r.canonical_name, r.epithet, r.authorship, r.taxon_rank, r.source) for r in taxonomies.build_names(spark, {"WCVP": str(path)}).collect())
    assert got == [("Rosa", None, None, "genus", "WCVP"), ("Rosa × alba", "alba", "L.", "species", "WCVP")]
    assert taxonomies.sniff_separator("a;b\n1;2,3\n") == ";" and taxonomies.sniff_separator("a\tb\nc\td\n") == "\t"
    with pytest.raises(ValueError):
        taxonomies.build_names(spark, {"IPNI": str(path)})
    with pytest.raises(ValueError):
        taxonomies.sniff_separator("abc")


def test_written_rows(spark, known, tmp_path):
    found = plan.extract(lines(spark, ["Rosa × hybrida", "nothing"]), known)
    folder = str(tmp_path / "out")
    sinks.write_rows(found, folder)
    (file,) = (tmp_path / "out" / "document=1").glob("*.csv")
    text = file.read_bytes().decode()
    assert text.startswith("line\textracted_name\t") and "\r\n0\tRosa × hybrida\tRosa × hybrida\t1\tspecies\t" in text and "\tTrue\t" in text
    docs = spark.createDataFrame([(1,), (2,)], "doc long")
    assert [r.doc for r in sinks.skip_existing(docs, "doc", spark, folder).collect()] == [2]
    assert sinks.skip_existing(docs, "doc", spark, str(tmp_path / "none")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_rows(found, folder, form="xls")
    made = plan.dictionaries(known)
    sinks.write_dictionaries(made, str(tmp_path / "cache"))
    assert sinks.read_dictionaries(spark, str(tmp_path / "cache")).canonical.count() == made.canonical.count()
    log = sinks.JobLog({"a": "b"}, processed=["x"])
    log.finish(spark, str(tmp_path / "log"))
    assert json.loads(spark.read.text(str(tmp_path / "log")).first()[0])["processed"] == ["x"]


def test_result_does_not_depend_on_partitions(spark, known):
    df = lines(spark, ["Rosa alba", "- rubra", "XX-0-TEBLI-1", "", "Silene flos-jovis", "x [syn. Rosa alba]"])
    one, many = (sorted(map(str, plan.extract(df.repartition(k), known).collect())) for k in (1, 5))
    assert one == many and len(one) >= 3


def test_empty_tables(spark, known):
    assert plan.extract(lines(spark, []), known).count() == 0
    assert plan.extract(lines(spark, ["Rosa alba"]), known.limit(0)).count() == 0
    assert set(rows.COLUMNS) < set(plan.extract(lines(spark, []), known).columns)
    assert context.near_blocks(lines(spark, []).withColumn("n", F.lit(True)), "n", "raw").count() == 0


def test_stream_equals_batch(spark, known, tmp_path):
    for doc in (1, 2):
        lines(spark, ["Rosa alba", "- rubra"], doc).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = extraction.extract_stream(extraction.stream_lines(spark, str(tmp_path / "in"), 1), known, lambda df, n: df.write.mode("overwrite").parquet(str(tmp_path / "out" / str(n))), str(tmp_path / "ck"))
    stream.awaitTermination(240)
    assert spark.read.parquet(*map(str, (tmp_path / "out").iterdir())).count() == 4


def test_fuzzy_takes_the_first_in_load_order(spark, known):
    rows = [(20 + i, f"Rosa alb{c}", "Rosa", f"alb{c}", None, None, "species", "WFO", 2) for i, c in enumerate("afdbce")]
    made = plan.dictionaries(spark.createDataFrame(rows, NAMES))
    asked = spark.createDataFrame([("Rosa alza",), ("Rosa albzzz",)], "s string")
    assert {r.lookup: r.canonical_name for r in lookup(asked, "s", made, fuzzy=True).collect()} == {"Rosa alza": "Rosa alba", "Rosa albzzz": "Rosa alba"}
    got = match.match_fuzzy(asked, "s", made.canonical, 0.7).collect()
    assert {r.lookup: (r.canonical_name, r.score) for r in got} == {"Rosa alza": ("Rosa alba", 0.78), "Rosa albzzz": ("Rosa alba", 0.7)}


def test_an_epithet_may_hide_a_name(spark, known):
    made = plan.dictionaries(known)
    asked = spark.createDataFrame([("concinnun",), ("adiantum concinnun",)], "s string")
    assert {r.canonical_name for r in lookup(asked, "s", made, fuzzy=True, include_epithets=True).collect()} == {"Adiantum concinnum"}
    assert {r.lookup for r in lookup(asked, "s", made, fuzzy=True, include_epithets=True).collect()} == {"adiantum concinnun"}


@pytest.mark.parametrize("cutoff", [0.9, 0.75, 0.3])
def test_cutoff_equals_brute_force(spark, small, cutoff):
    from hortulus.functions.similarity import ratio

    base = spark.read.parquet(f"{small}/reference_names.parquet").where("ref_id <= 150")
    fields = ("canonical_name", "genus", "epithet", "infraspecific_epithet", "authorship", "taxon_rank")
    canonical = names.canonical_dictionary(base.select(F.col("ref_id").alias("ord"), *fields, F.lit("WFO").alias("source"), F.lit(1).alias("prio")))
    keys = [(r.key, r.ord, r.canonical_name.lower()) for r in canonical.collect()]
    asked = sorted({r[0] for r in spark.read.parquet(f"{small}/list_entries.parquet").where("extracted_name <> ''").select(tx.fully_clean(F.col("extracted_name"))).distinct().limit(120).collect()} - {""})
    want = {}
    for a in asked:
        _, _, name = min((edits(a, k), o, n) for k, o, n in keys)
        if ratio(a, name) >= cutoff:
            want[a] = (name, round(ratio(a, name), 2))
    got = match.match_fuzzy(spark.createDataFrame([(a,) for a in asked], "s string"), "s", canonical, cutoff)
    assert {r.lookup: (r.canonical_name.lower(), r.score) for r in got.collect()} == want


def test_rounding_is_that_of_binary_numbers(spark):
    values = [0.925, 0.975, 0.955, 0.295, 0.125, 2 * 17 / 37, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", match.python_round(F.col("v")).alias("r"))
    assert all(x.r == (None if x.v is None else round(x.v, 2)) for x in df.collect())


def test_long_documents_are_read_in_linear_time(spark):
    import time

    df = spark.range(200_000).select(F.lit(1).alias("doc"), F.col("id").cast("int").alias("line_nr"), F.when(F.col("id") == 199_999, "XX-0-TEBLI-1").alias("ipen"), (F.col("id") == 0).alias("has_name"), F.lit("x").alias("raw"))
    began = time.time()
    assert df.select(context.next_code().alias("c")).where("c <> ''").count() == 200_000
    assert context.near_blocks(df, "has_name", "raw").count() == 1
    assert context.split_codes(df, "raw", "raw").count() == 0
    assert time.time() - began < 120


def test_legend_descriptions_are_stripped(spark, known):
    found = extracted(spark, known, ["Rosa alba L. ♃ x", "   ♃ =  Annual plant here", "Silene flos-jovis L. ☉ y", "see  below: ☉ for  annual plants "])
    assert found[0]["extracted_notes"] == "♃ = Annual plant here"
    assert found[1]["extracted_notes"] == "see  below: ☉ for  annual plants"


def test_documents_may_have_names_as_idents(spark, known):
    df = lines(spark, ["Rosa alba L.", "- rubra"]).withColumn("doc", F.lit("a.txt"))
    assert [r.match_name for r in plan.extract(df, known).orderBy("line").collect()] == ["Rosa alba", "Rosa rubra"]
