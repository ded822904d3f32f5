import pytest
from pyspark.sql import functions as F

from hortulus.functions import text as tx
from hortulus.functions.similarity import indel_ratio


def value(spark, column, *texts):
    df = spark.createDataFrame([(*texts,)], ", ".join(f"c{i} string" for i in range(len(texts))))
    return df.select(column(*[F.col(f"c{i}") for i in range(len(texts))])).first()[0]


@pytest.mark.parametrize(
    "function, text, expected",
    [
        (tx.preprocess_line, "\tA — b ……… c ______ ■ d ", "A - b ……… c _   d"),
        (tx.preprocess_line, "INDEX  Seminum 1900", "1900"),
        (tx.preprocess_line, "Rosa x alba X  nigra", "Rosa × alba ×  nigra"),
        (tx.preprocess_line, "Rosa ..... 4", "Rosa . 4"),
        (tx.preprocess_line, "Rosa .... 4", "Rosa .... 4"),
        (tx.preprocess_line, "", ""),
        (tx.trim_outer, "13. Rosa alba, L.)", "Rosa alba, L."),
        (tx.trim_outer, "(Rosa) 12", "Rosa"),
        (tx.trim_outer, "12", ""),
        (tx.clean_name, "Rosa × d'alba-2", "Rosa d alba"),
        (tx.drop_abbreviations, "Rosa aff. alba var nana gx. cl f.", "Rosa alba nana gx."),
        (tx.fully_clean, "Rosa alba subsp. nana", "Rosa alba nana"),
        (tx.cultivar, "Rosa ’Nana‘ x", "’Nana‘"),
        (tx.cultivar, "Rosa (dwarf FORM)", "(dwarf FORM)"),
        (tx.cultivar, "Rosa 'B12'", None),
        (tx.ipen, "a XX-0-TEBLI-00857 [ex", "XX-0-TEBLI-00857"),
        (tx.ipen, "xx.1.bg/9]", "xx.1.bg/9"),
        (tx.ipen, "Xx-0-BG-1", None),
        (tx.garden_of, "TEBLI-2020-G-x-a-1-I.txt", "TEBLI"),
        (tx.year_of, "TEBLI-2020-G-x-a-1-I.txt", 2020),
        (tx.year_of, "A-99999", None),
        (tx.year_of, "A-19999", 1999),
        (tx.repeat_symbols, "12. - — rosa", ["-", "—"]),
        (tx.repeat_symbols, "rosa -", []),
        (tx.synonym_strings, "a [syn. Rosa alba] [Sin: x] (syn. Lychnis flos-jovis (L.) Desr.)", ["Rosa alba", "Sin: x"]),
        (tx.split_lines, "a\r\nb\x0cc\x1cd\n\n", ["a", "b", "c", "d", ""]),
        (tx.split_lines, "", []),
    ],
)
def test_functions(spark, function, text, expected):
    assert value(spark, function, text) == expected
    assert value(spark, function, None) is None


def test_python_agrees_on_lines(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("text IS NOT NULL").select("text", tx.split_lines(F.col("text")).alias("l")).collect()
    assert all(r.l == r.text.splitlines() for r in docs)


@pytest.mark.parametrize("a, b, ratio", [("Adianthum concinnum", "adiantum concinnum", 2 * 17 / 37), ("adianthum", "adiantum", 16 / 17), ("", "", 1.0), ("a", "", 0.0), ("abc", "cba", 2 / 6)])
def test_ratio(spark, a, b, ratio):
    assert value(spark, indel_ratio, a, b) == pytest.approx(ratio)
    assert value(spark, indel_ratio, None, b) is None
