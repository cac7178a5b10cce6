"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded shuffled order, offered
up to ``max_epochs`` times. A copy's virtual finish time is the number of
words its source has sent by its end, divided by the source's target. All
copies are range-sorted by that time and taken until the budget (all words
of the input) is reached, so each source sends words in proportion to its
target at every moment.

Targets: the budget is shared by weight; a source stops at ``max_epochs``
times its size and the excess is shared again by weight among the others.

No task sorts a whole source: running totals come from range partitions and
one offset per partition. The driver sees two numbers and one cut position.

Defined results: a null text has size 0; documents of size 0 and documents
of a source without words take nothing; a null source is the last source;
a null doc_id is shuffled like any other; rows equal in doc_id, source and
size are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialize, packed, ranged_running_sum, split_by_keys, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def word_count(column: str = "text") -> Column:
    return F.size(F.regexp_extract_all(text_or_empty(column), F.lit(WORD), F.lit(0))).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, rank, weight, target of every source of ``sizes``
    (columns source, size): the water level that spends the whole budget."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")) \
        .withColumn("_last", F.col("source").isNull()).withColumn("_one", F.lit(1).cast("long"))
    ranked = ranged_running_sum(per, ["_last", "source"], "_one").withColumnRenamed("running", "rank")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", pick.cast("long")) \
        .withColumn("cap", F.col("source_size") * max_epochs) \
        .withColumn("_level", F.col("cap").cast("double") / F.col("weight"))
    ranked = materialize(ranked.drop("_one", "_last"), "sources")
    # Sources fill up in order of cap / weight; the level after k of them are
    # full is what remains of the budget over the weights that still take.
    order = ["_level", "rank"]
    full = ranged_running_sum(ranked, order, "cap").withColumnRenamed("running", "_caps")
    full = ranged_running_sum(full, order, "weight").withColumnRenamed("running", "_weights")
    full = materialize(full, "levels")
    sums = full.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, weight = int(sums[0] or 0), int(sums[1] or 0)
    level = (F.lit(budget) - F.col("_caps") + F.col("cap")).cast("double") \
        / (F.lit(weight) - F.col("_weights") + F.col("weight"))
    found = full.withColumn("_try", level).filter("_try <= _level") \
        .agg(F.min(F.struct("_level", "rank", "_try")).alias("m")).first()
    water = found[0]["_try"] if found and found[0] is not None else 0.0
    return ranked.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(float(water)) * F.col("weight"))) \
        .select("source", "source_size", "rank", "weight", "target")


def _finish(epoch: Column) -> Column:
    return ((epoch * F.col("source_size") + F.col("cum")).cast("double")) / F.col("target")


def _spot(seed: str, doc_id: str = "doc_id") -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(doc_id).cast("string")))


def _queues(docs: DataFrame, weights: tuple, max_epochs: int, seed: str) -> DataFrame:
    """The queues of all sources, each in the order of spot, doc_id and size, with
    ``copies``: how many of its epochs the mix takes of a row. Within a source
    and an epoch the mix takes the rows up to some place in the queue."""
    sizes = materialize(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    targets = materialize(source_targets(sizes, weights, max_epochs), "targets")
    shuffled = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])) \
        .select("doc_id", "size", targets["source"], "source_size", "rank", "target",
                _spot(seed).alias("spot"))
    queued = ranged_running_sum(materialize(shuffled, "shuffled"), ["rank", "spot", "doc_id", "size"], "size", "rank") \
        .withColumnRenamed("running", "cum")
    queued = materialize(queued, "queued")
    budget = int(targets.agg(F.sum("source_size")).first()[0] or 0)
    offered = queued.filter("size > 0 and target > 0") \
        .select("rank", "cum", "size", "source_size", "target",
                F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"))
    offered = offered.select(_finish(F.col("epoch")).alias("finish"), "rank", "epoch", "cum", "size")
    sent = ranged_running_sum(offered, ["finish", "rank", "epoch", "cum"], "size")
    key = ["finish", "rank", "epoch", "cum"]
    cut = sent.filter(F.col("running") <= budget).agg(F.max(F.struct(*key))).first()
    cut = cut[0] if cut else None
    if cut is None:
        copies = F.lit(0)
    else:
        last = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["rank"]).alias("rank"),
                        F.lit(cut["epoch"]).alias("epoch"), F.lit(cut["cum"]).alias("cum"))
        copies = sum((F.when(F.struct(_finish(F.lit(e)).alias("finish"), F.col("rank"),
                                      F.lit(e).alias("epoch"), F.col("cum")) <= last, 1).otherwise(0)
                      for e in range(max_epochs)), F.lit(0))
        copies = F.when((F.col("size") > 0) & (F.col("target") > 0), copies).otherwise(0)
    return queued.withColumn("copies", copies.cast("int"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken
    (words), copies (how often the document is in the mix)."""
    return _queues(docs, weights, max_epochs, seed).select(
        "doc_id", "size", "source", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                    seed: str = SEED) -> DataFrame:
    """The rows of the mix with all columns of ``docs``: each document as often
    as it was taken, none that was not. Rows that repeat a (doc_id, source,
    size) are interchangeable for the mix but may differ in other columns;
    they share the copies that fell to them in order of text.

    Texts stay where they are: a row's place in its queue follows from its own
    values, and up to which place an epoch of a source is taken is one row a
    source. Only rows that repeat a (doc_id, source, size) are moved."""
    queues = _queues(docs, weights, max_epochs, seed)
    epochs = range(max_epochs)
    place = F.struct("spot", "doc_id", "size")
    # Written: small, and Spark then knows its size.
    ends = materialize(queues.where("copies > 0").groupBy(F.col("source").alias("_source"))
                       .agg(*[F.max(F.when(F.col("copies") > e, place)).alias(f"_end{e}") for e in epochs]), "mix-ends")
    ties = materialize(queues.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_of"), F.col("size").alias("_words"))
                       .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).filter("_rows > 1"), "mix-ties")
    single = packed(docs, _doc=F.col("doc_id"), _from=F.col("source"), _own=word_count(), _text=text_or_empty())
    found = None
    if not ties.isEmpty():
        on = F.col("_doc").eqNullSafe(F.col("_id")) & F.col("_from").eqNullSafe(F.col("_of")) & (F.col("_own") == F.col("_words"))
        others, found = split_by_keys(single, ["_doc", "_from", "_own"], ties, ["_id", "_of", "_words"])
        single = others.unionByName(found.join(ties, on, "left_anti"))
    here = F.struct(_spot(seed, "_doc").alias("spot"), F.col("_doc").alias("doc_id"), F.col("_own").alias("size"))
    n = sum((F.when(here <= F.col(f"_end{e}"), 1).otherwise(0) for e in epochs), F.lit(0))
    rows = single.drop("_text").where("_own > 0").join(ends, F.col("_from").eqNullSafe(F.col("_source"))) \
        .select("_row", n.cast("long").alias("_n"))
    if found is not None:
        # Ranked by a range sort: such a group may hold any share of the rows.
        tied = found.join(ties.where("_copies > 0"), on).select(
            "_row", "_text", "_copies", "_rows", F.to_json(F.struct("_id", F.col("_of").alias("_source"), "_words")).alias("_group"),
            F.lit(1).cast("long").alias("_one"))
        ranked = ranged_running_sum(tied, ["_group", "_text"], "_one", "_group")
        extra = F.when(F.col("running") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
        rows = rows.unionByName(ranked.select("_row", (F.floor(F.col("_copies") / F.col("_rows")) + extra).alias("_n")))
    return rows.filter("_n > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_copy")) \
        .select("_row.*")
