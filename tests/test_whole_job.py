import pytest

from hortulus import catalog

NAME = "ord long, canonical_name string, genus string, epithet string, infraspecific_epithet string, authorship string, taxon_rank string, source string"
NAMES = [(1, "Adiantum concinnum", "Adiantum", "concinnum", None, "L.", "species", "WFO"), (2, "Silene palustris", "Silene", "palustris", None, "L.", "species", "WFO")]


def folder(spark, path, texts, contents=()):
    """Tables of one text file of the lines `texts` and a json file for each of `contents`."""
    files = [(1, "TEBLI-2020-x.txt", "txt", None)] + [(2 + i, f"TEBLI-2020-{i}.json", "json", c) for i, c in enumerate(contents)]
    parts = {
        "name_lookup": (NAMES, NAME),
        "name_sources": ([("WFO", 1)], "source string, priority int"),
        "document_lines": ([(i, 1, i, t) for i, t in enumerate(texts)], "line_id long, file_id long, line_nr int, raw_line string"),
        "seedlist_files": (files, "file_id long, filename string, file_format string, content string"),
    }
    for name, (data, schema) in parts.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["fuzzy_best_score", "fuzzy_longest_name"])
def test_fuzzy_tries_lines_far_from_named_ones(spark, tmp_path, name):
    texts = ["Adiantum concinnum"] + ["."] * 150 + ["Silene palustriss"] + ["."] * 20
    got = catalog.queries()[name](spark, folder(spark, tmp_path, texts)).collect()
    assert [(r.line_nr, r.canonical_name) for r in got] == [(151, "Silene palustris")]


def test_json_files_are_extracted(spark, tmp_path):
    contents = ["Index\nAdiantum concinnum", "<html><body><div><p>Index</p><p>Silene palustris</p></div></body></html>"]
    where = folder(spark, tmp_path, ["Adiantum concinnum"], contents)
    got = {(r.filename, r.match_name) for r in catalog.queries()["extract_rows"](spark, where).collect()}
    assert got == {("TEBLI-2020-x.txt", "Adiantum concinnum"), ("TEBLI-2020-0.json", "Adiantum concinnum"), ("TEBLI-2020-1.json", "Silene palustris")}
    assert {r.doc for r in catalog.queries()["genera_scores"](spark, where).collect()} == {1, 2, 3}
