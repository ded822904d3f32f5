import json

import pytest
from pyspark.sql import functions as F

from hortulus.__main__ import main
from hortulus.sources import documents, sinks, taxonomies

WCVP = "|".join(taxonomies.SOURCES["WCVP"].columns) + "\nRosa alba|Rosa|alba||L.|Species\nRosa|Rosa||||Genus\nSilene flos-jovis|Silene|flos-jovis||(L.) Greuter|Species\n"


@pytest.fixture(scope="module")
def names(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("names")
    (folder / "wcvp.csv").write_text(WCVP)
    main(["names", str(folder / "table"), f"WCVP={folder}/wcvp.csv", f"WFO={folder}/missing.csv"])
    spark.createDataFrame([("WCVP", 1)], "source string, priority int").write.parquet(str(folder / "sources"))
    return folder


def test_one_bad_document_stops_nothing(spark, names, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "TEBLI-1999.txt").write_text("1 Rosa alba L.\n2 Rosa albba\n")
    (docs / "bad.json").write_text("{ not json")
    (docs / "good.json").write_text(json.dumps({"document": {"content": "Silene flos-jovis"}}))
    (docs / "none.txt").write_text("nothing here")
    common = ["extract", str(docs), f"{names}/table", "--sources", f"{names}/sources", "--cache", str(tmp_path / "cache"), "--log", str(tmp_path / "log")]
    main([*common, "--output", str(tmp_path / "out"), "--threshold", "0.8"])
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["TEBLI-1999.tsv", "good.tsv"]
    text = (tmp_path / "out" / "TEBLI-1999.tsv").read_bytes().decode()
    assert text.startswith("line\textracted_name\t") and "\r\n0\tRosa alba\tRosa alba\t1\tspecies\t" in text and "\r\n1\tRosa albba\tRosa alba\t" in text
    log = json.loads(spark.read.text(str(tmp_path / "log")).first()[0])
    assert [len(log[k]) for k in ("processed", "failed", "skipped", "output")] == [3, 1, 0, 2] and log["failed"][0].endswith("bad.json")
    assert log["counters"] == {"rows": 3, "exact": 2, "fuzzy": 1}
    (tmp_path / "out" / "good.tsv").unlink()
    main([*common[:-1], str(tmp_path / "log2"), "--output", str(tmp_path / "out"), "--skip-existing"])
    log = json.loads(spark.read.text(str(tmp_path / "log2")).first()[0])
    assert [p.rsplit("/", 1)[1] for p in log["skipped"]] == ["TEBLI-1999.txt"] and (tmp_path / "out" / "good.tsv").exists()
    main([*common[:-2], "--in-situ", "--format", "csv"])
    assert sorted(p.name for p in docs.iterdir() if p.suffix == ".csv") == ["TEBLI-1999.csv", "good.csv"]


def test_lookup(names, capsys, monkeypatch):
    common = ["lookup", f"{names}/table", "--sources", f"{names}/sources"]
    main([*common[:2], "Rosa alba", *common[2:]])
    assert "Rosa alba --> Rosa alba (1.0) L. [WCVP]" in capsys.readouterr().out
    monkeypatch.setattr("sys.stdin", ["e+alba\n", "Rosa albba\n", "\n", "q\n", "never\n"])
    main(common)
    assert capsys.readouterr().out.splitlines()[-3:] == ["alba --> alba (1.0)", "no match", "Rosa albba --> Rosa alba (0.84) L. [WCVP]"]


def test_parsers_are_pluggable(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"Rosa alba")
    (tmp_path / "b.pdf").write_bytes(b"!")
    (tmp_path / "c.txt").write_bytes(b"x")

    def parser(data):
        if data == b"!":
            raise ValueError("broken")
        return data.decode()

    got = {r.filename: (r.text, r.error) for r in documents.read_binary(spark, str(tmp_path), parser).collect()}
    assert got == {"a.PDF": ("Rosa alba", None), "b.pdf": (None, "ValueError: broken")}
    sinks.write_envelopes(documents.read_binary(spark, str(tmp_path), parser), str(tmp_path / "json"), "plain")
    (row,) = spark.read.json(str(tmp_path / "json")).collect()
    assert (row.filename, row.parser, row.document.content) == ("a.PDF", "plain", "Rosa alba")


@pytest.mark.parametrize("page", ["utf-8", "utf-16-le", "cp1252", "cp1251", "koi8-r", "cp866"])
def test_encodings(page):
    text = "Größe für Gärten und Höhe" if page in ("utf-8", "utf-16-le", "cp1252") else "Сухой склон у озера, Семена"
    assert text.encode(page).decode(documents.guess_encoding(text.encode(page))) == text


def test_a_document_is_never_overwritten(spark):
    df = spark.createDataFrame([("/a/b.c/x.tsv",)], "p string")
    assert df.select(sinks.output_path(F.col("p"), "/out")).first()[0] == "/out/x.tsv"
    with pytest.raises(Exception, match="would overwrite"):
        df.select(sinks.output_path(F.col("p"))).collect()
