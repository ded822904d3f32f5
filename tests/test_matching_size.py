from pyspark.sql import functions as F

from hortulus.operators import match


def test_wide_dictionaries_are_not_broadcast(spark):
    many = spark.range(100_000).select(F.col("id").cast("string").alias("key"))
    assert "strategy=broadcast" not in match.sized(many)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in match.sized(many.limit(10))._jdf.queryExecution().analyzed().toString()


def test_sieve_loses_no_entry(spark):
    entries = spark.range(5000).select(F.concat(F.lit("name "), "id").alias("entry"))
    bits = match.sieve(entries)
    passed = lambda df: df.join(F.broadcast(bits), match.may_be_in(F.col("entry"), F.col("bits"))).count()
    assert passed(entries) == 5000
    assert passed(entries.select(F.concat(F.lit("x"), "entry").alias("entry"))) < 500


def test_sieved_windows_keep_all_matches(spark):
    keys = ["silene flos jovis", "flos jovis", "rosa", "rosa alba", "rosa alba nana"]
    known = spark.createDataFrame([(k, "name", False, k) for k in keys], "key string, kind string, genus_rank boolean, match string")
    texts = ["12) Silene flos-jovis L.", "flos-jovis", "5. subsp. Rosa x alba var. nana", "", "rosa ... alba", "é rosa-alba", "nana"]
    lines = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    got = {(r.n, r.i, r.j, r.match) for r in match.leftmost_longest(lines, ["n"], "text", known, 3).collect()}
    every = match.windows(lines, ["n"], "text", 3).join(known, "key").groupBy("n").agg(F.min_by(F.struct("i", "j", "match"), F.struct("i", -F.col("j"))).alias("h"))
    assert got == {(r.n, r.h.i, r.h.j, r.h.match) for r in every.collect()}
    assert {(n, m) for n, _, _, m in got} == {(0, "silene flos jovis"), (1, "flos jovis"), (2, "rosa"), (4, "rosa alba"), (5, "rosa alba")}


def test_documents_get_names_without_authorships(spark, monkeypatch):
    from hortulus.operators import context
    from hortulus.plans import extract as plan

    given = []
    whole = context.document_dictionary
    monkeypatch.setattr(context, "document_dictionary", lambda lines, canonical: given.append(canonical.columns) or whole(lines, canonical))
    names = "ord long, canonical_name string, genus string, epithet string, infraspecific_epithet string, authorship string, taxon_rank string, source string, prio int"
    known = plan.dictionaries(spark.createDataFrame([(1, "Rosa alba", "Rosa", "alba", None, "L.", "species", "WFO", 1)], names))
    lines = spark.createDataFrame([(1, 0, "Rosa alba")], "doc long, line_nr int, raw string")
    context.resolve_epithets(plan.recognise(lines, known), known.canonical)
    assert given == [["key", "canonical_name", "taxon_rank"]]
