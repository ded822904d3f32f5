"""Mixing sources to target weights, in tokens of a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hortulus.llm.bpe import count_tokens
from hortulus.runtime import cut_lineage

BUCKET_BITS = 12


def distinct_texts(documents: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, order_key): one row for each distinct text that has tokens, that of its smallest ident.

    A text that stands in several documents, of one source or more, belongs to the first, so no use of it goes uncounted.
    The order key is a hash of the text: a random order that any rerun repeats.
    """
    sized = count_tokens(
        documents.where(F.col(ident).isNotNull()).select(F.col(ident).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("__text")), "__text", vocabulary=vocabulary
    )
    keyed = sized.where("n_tokens > 0").select("doc_id", "source", "n_tokens", F.md5("__text").alias("__md5"))
    first = keyed.groupBy("__md5").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("__first"))
    return first.select("__first.*", F.xxhash64("__md5").alias("order_key"))


def mix_sources(documents: DataFrame, weights: DataFrame, total_tokens: int | None = None, vocabulary: str | None = None, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares).

    Each source gets a budget of target_share times the total. Its texts are taken in hash-random order, whole passes first
    (epochs, at most max_repeats), and the last pass is cut exactly at the budget: the text on the cut counts with its first
    take_tokens tokens only. Prefix sums are distributed: the random keys are range-partitioned at fixed splits into
    (source, bucket), summed per bucket, the small table of bucket sums (at most sources * 4096 rows) is accumulated, and the
    running sums are completed inside each bucket, so a source that holds most rows is spread over all its buckets.

    With total_tokens None the total is the largest at which every source that has any text reaches its share; a given total
    may ask more of a source than its texts times max_repeats: it then gives all it may and falls short, as shares shows.

    mixture: source, epoch (from 1), doc_id, order_key, n_tokens, take_tokens; a manifest that is joined to the texts by doc_id.
    shares: source, target_share, max_repeats, n_texts, available_tokens, budget_tokens, taken_tokens, actual_share, passes.
    Documents without a source, with one that has no weight, or without tokens are in no mixture, and do not count as the first
    copy of a text. A source without texts has taken 0. Weights with null source, share or repeats are ignored. Repeated weights
    of a source count once (the largest).
    """
    wanted = weights.where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    source = columns.get("source", "source")
    # copies without a wanted source take no text from one that has it
    usable = documents.join(F.broadcast(wanted.select(F.col("source").alias("__wanted"))), F.col(source) == F.col("__wanted"), "left_semi")
    texts = cut_lineage(distinct_texts(usable, vocabulary=vocabulary, **columns))  # tokenised once, used three times
    bucketed = texts.withColumn("bucket", F.shiftrightunsigned("order_key", 64 - BUCKET_BITS))
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("texts"))
    by_source = sums.groupBy("source").agg(F.sum("tokens").alias("available_tokens"), F.sum("texts").alias("n_texts"))
    supply = wanted.join(F.broadcast(by_source), "source", "left").na.fill(0, ["available_tokens", "n_texts"])
    if total_tokens is None:
        reach = F.when(F.col("available_tokens") > 0, F.col("available_tokens") * F.col("max_repeats") / F.col("target_share"))
        total = supply.agg(F.coalesce(F.floor(F.min(reach)), F.lit(0)).alias("total"))
    else:
        total = supply.agg(F.lit(int(total_tokens)).cast("long").alias("total"))
    budgets = (
        supply.crossJoin(F.broadcast(total))  # one row
        .withColumn("budget_tokens", F.floor(F.col("target_share") * F.col("total")).cast("long"))
        .withColumn("taken_tokens", F.least("budget_tokens", F.col("available_tokens") * F.col("max_repeats")).cast("long"))
        .withColumn("whole", F.when(F.col("available_tokens") > 0, F.expr("taken_tokens div available_tokens")).otherwise(F.lit(0)))
        .withColumn("rest", F.col("taken_tokens") - F.col("whole") * F.col("available_tokens"))
    )
    before_bucket = F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("source", "bucket", F.coalesce(before_bucket, F.lit(0)).alias("bucket_start"))
    within = Window.partitionBy("source", "bucket").orderBy("order_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        bucketed.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(F.broadcast(offsets), ["source", "bucket"])
        .join(F.broadcast(budgets.select("source", "whole", "rest")), "source")
        .withColumn("left", F.col("rest") - F.col("bucket_start") - F.col("inside"))
        .withColumn("passes", F.col("whole") + F.when(F.col("left") > 0, 1).otherwise(0))
        .where("passes > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("passes").cast("int"))))
    )
    partial = (F.col("epoch") > F.col("whole")) & (F.col("left") < F.col("n_tokens"))
    mixture = placed.select("source", "epoch", "doc_id", "order_key", "n_tokens", F.when(partial, F.col("left")).otherwise(F.col("n_tokens")).cast("int").alias("take_tokens"))
    everything = budgets.agg(F.sum("taken_tokens").alias("everything"))
    shares = budgets.crossJoin(F.broadcast(everything)).select(
        "source",
        "target_share",
        "max_repeats",
        "n_texts",
        "available_tokens",
        "budget_tokens",
        "taken_tokens",
        F.when(F.col("everything") > 0, F.col("taken_tokens") / F.col("everything")).alias("actual_share"),
        F.when(F.col("available_tokens") > 0, F.col("taken_tokens") / F.col("available_tokens")).otherwise(F.lit(0.0)).alias("passes"),
    )
    return mixture, shares
