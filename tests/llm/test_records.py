import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from hortulus.llm import records

NAME = "ord long, canonical_name string, genus string, epithet string, infraspecific_epithet string, authorship string, taxon_rank string, source string, loaded_at timestamp"
DAY = datetime.datetime(2024, 1, 1)


def names(spark, rows):
    return spark.createDataFrame([(*r[:8], r[8] if len(r) > 8 else None) for r in rows], NAME)


def sources(spark):
    return spark.createDataFrame([("A", 1), ("B", 2)], "source string, priority int")


KEY = records.name_key


def key():
    return records.name_key("canonical_name", "genus", "epithet", "infraspecific_epithet", "taxon_rank")


def record():
    return records.record_key("canonical_name", "genus", "epithet", "infraspecific_epithet", "taxon_rank", ["authorship", "source"])


@pytest.mark.parametrize(
    "a, b, same",
    [
        (("Rosa alba", "Rosa", "alba", None), ("ROSA_alba", "rosa", " Alba.", ""), True),
        (("Rosa alba", "Rosa", "alba", None), ("alba, Rosa", "alba", "Rosa", None), True),
        (("Rosa a-b", "Rosa", "a-b", None), ("Rosa ab", "Rosa", "a‐b", None), True),
        (("Rosa alba var. nana", "Rosa", "alba", "nana"), ("nana var. alba Rosa", "Rosa", "nana", "alba"), False),
        (("Rosa alba var. nana", None, None, None), ("Rosa nana var. alba", None, None, None), False),
        (("Rosa alba var. nana", "Rosa", "alba", "nana"), ("Rosa alba f. nana", "Rosa", "alba", "nana"), False),
        (("Rosa × alba", "Rosa", "alba", None), ("Rosa alba", "Rosa", "alba", None), False),
        (("× alba Rosa", "Rosa", "alba", None), ("Rosa × alba", "Rosa", "alba", None), True),
        ((None, None, None, None), ("", "", "", ""), True),
    ],
)
def test_name_key(spark, a, b, same):
    rows = names(spark, [(1, *a, None, "species", "A"), (2, *b, "x", "SPECIES ", "B")])
    assert (rows.select(key().alias("k")).distinct().count() == 1) is same


def test_copies_equal_brute_force_with_hot_keys(spark):
    rows = [(i, "Rosa alba" if i % 3 else "alba / ROSA", "Rosa", "alba", None, "L.", "species", "A") for i in range(60)]
    rows += [(100 + i, f"Rosa x{i % 7}", "Rosa", f"x{i % 7}", "", None, "species", "A") for i in range(30)]
    df = names(spark, rows)
    groups: dict = {}
    for r in df.select("ord", record().alias("k")).collect():
        groups.setdefault(r.k, []).append(r.ord)
    expected = sorted((min(g), o) for g in groups.values() for o in g if o != min(g))
    for least in (5, 10**6):  # with and without hot keys
        assert sorted(map(tuple, records.copy_pairs(df, "ord", record(), least=least).collect())) == expected
        counts = {tuple(r) for r in records.collapse_copies(df, "ord", record(), least=least).collect()}
        assert counts == {(min(g), len(g)) for g in groups.values()}


def test_copies_edge_cases(spark):
    empty = names(spark, [])
    assert records.copy_pairs(empty, "ord", record()).count() == 0
    assert records.collapse_copies(empty, "ord", record()).count() == 0
    long = "a" * 200_000
    rows = names(spark, [(1, long, None, None, None, None, None, None), (1, long, "", "", "", "", "", ""), (None, long, None, None, None, None, None, None), (2, long.upper(), None, None, None, None, None, None)])
    clash = rows.withColumn("__key", F.lit(1)).withColumn("__ident", F.lit(2)).withColumn("copies", F.lit(3))
    assert [tuple(r) for r in records.copy_pairs(clash, "ord", record()).collect()] == [(1, 2)]
    assert [tuple(r) for r in records.collapse_copies(clash, "ord", record()).collect()] == [(1, 4)]


def best(df, sources, **options):
    fields = {"name": (F.concat_ws("|", "canonical_name", "source"), F.lit(True)), "authorship": (F.col("authorship"), records.names_an_author(F.col("authorship")))}
    return records.best_representatives(df, sources, "ord", key(), fields, **options)


def test_best_by_precedence(spark):
    n = ("Rosa alba", "Rosa", "alba", None)
    df = names(
        spark,
        [
            (5, *n, "L.", "species", "B", DAY),
            (6, *n, "n/a", "species", "A", None),
            (7, *n, "—", "species", "A", DAY),
            (8, *n, "Mill.", "species", "A", DAY - datetime.timedelta(1)),
            (9, *n, "Mill.", "species", "Z", DAY),
            (10, "Rosa rubra", "Rosa", "rubra", None, "L.", "species", "A", DAY),
            (11, "Rosa nova", "Rosa", "nova", None, "", "species", None, None),
            (12, "Rosa nova", "Rosa", "nova", None, None, "species", None, None),
        ],
    )
    got = {r.group_ord: (r.copies, r.name_ord, r.authorship_ord) for r in best(df, sources(spark), policy="precedence").collect()}
    assert got == {5: (5, 7, 8), 11: (2, 11, None)}
    assert best(df.limit(0), sources(spark)).count() == 0


def test_best_by_votes(spark):
    n = ("Rosa alba", "Rosa", "alba", None)
    df = names(spark, [(1, *n, "L.", "species", "A", DAY), (2, *n, "Mill.", "species", "B", DAY), (3, *n, "mill", "species", "B", DAY), (4, *n, "MILL.", "species", "B", DAY)])
    row = best(df.withColumn("__votes", F.lit(1)), sources(spark)).first()
    assert (row.authorship, row.authorship_ord) == ("Mill.", 2)  # three votes of 1/2 beat one of 1
    old = DAY - datetime.timedelta(days=365 * 9)
    aged = names(spark, [(1, *n, "L.", "species", "A", DAY), *[(k, *n, "Mill.", "species", "B", old) for k in (2, 3, 4)]])
    assert best(aged, sources(spark)).first().authorship == "L."
    with pytest.raises(ValueError):
        best(df, sources(spark), policy="other")
    assert list(itertools.chain(*best(df.limit(0), sources(spark)).collect())) == []
