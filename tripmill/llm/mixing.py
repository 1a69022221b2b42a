"""Mixing sources to target weights by weighted fair queueing.

Every document of a source waits in that source's queue, in the order of a seeded hash. The virtual
finish time of its e-th copy is (words of the queue up to and with it + (e - 1) * words of the
source) / target of the source. All copies are sorted by finish time over the whole table, and the
mix is what fits the total budget from the front of that order.

Both running sums (within a source, over the whole order) are made the same way: range-sort slim
rows, add up inside each range, and shift each range by the sum of the ranges before it, of which
there are as many as partitions. A source with a third of all rows is many ranges. Texts are never
sorted or shuffled: what the order decides is, per source and copy, the last queue position that
still fits, and documents are compared with that.

Defined cases: a null text has size 0; size-0 documents are never taken; a null source is a source of
its own, sorted last; null ids take part; rows alike in id, source, size and text hash are taken or
left together with the last of them; an empty table gives an empty result. Other columns are kept by
``mix_documents`` and not read by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import for_python, n_words, written
from tripmill.session import fresh_folder

# --- parameters -------------------------------------------------------------------------------------
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
SEED = 42


def queue_key(seed: int = SEED) -> Column:
    """Place of a document in its queue: a seeded hash of id and text, so that a shared or missing id
    still spreads."""
    return F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("doc_id").cast("string"),
                                         F.md5(F.coalesce("text", F.lit(""))))), 1, 16)


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """Targets of a table (source, source_size): by weight, with what exceeds ``most`` times a size
    reshared among the others until none is above.

    Weights go round in the order of code points, null last. Only sums and counts come to the
    driver: each round is one aggregate over the sources, and it ends when no further one is full.
    """
    spark = sources.sparkSession
    ranked = numbered(sources.withColumn("_null", F.col("source").isNull().cast("int")),
                      ["_null", "source"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("_number", F.lit(len(weights))) + 1).cast("int"))
    path = fresh_folder(spark, "targets")
    table = written(ranked.select("source", "source_size", weight.alias("weight"),
                                  (F.col("source_size") * float(most)).alias("_limit"),
                                  F.col("_number")), path)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget = share * total
    rate, full_before = None, -1
    while True:
        # Full at the present rate are those whose share by weight reaches their limit.
        full = F.lit(False) if rate is None else F.col("weight") * F.lit(rate) > F.col("_limit")
        taken, weights_left, n_full = table.agg(
            F.sum(F.when(full, F.col("_limit")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.count_if(full)).first()
        if n_full == full_before or not weights_left:
            break
        full_before, rate = n_full, (budget - taken) / weights_left
    by_weight = F.col("weight") * F.lit(rate if rate is not None else 0.0)
    return table.select("source", "source_size", "_number",
                        F.least(by_weight, F.col("_limit")).alias("target"))


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_number`` from 0 in an order, by range sort and one count per range."""
    return running_sum(df.withColumn("_one", F.lit(1).cast("long")), order, "_one",
                       "_number").withColumn("_number", F.col("_number") - 1).drop("_one")


def running_sum(df: DataFrame, order: Sequence[str], value: str, into: str) -> DataFrame:
    """Add the sum of ``value`` over all rows up to each one in an order.

    The sorted rows with the sums inside their range are written once, so ranges cannot shift between
    the two passes when an executor is lost.
    """
    spark = df.sparkSession
    for_python(spark)
    schema = df.withColumns({into: F.lit(0).cast("long"), "_range": F.lit(0)}).schema

    def add_up(batches):
        from pyspark import TaskContext

        before, place = 0, TaskContext.get().partitionId()
        for rows in batches:
            sums = rows[value].cumsum() + before
            if len(rows):
                before = int(sums.iloc[-1])
            yield rows.assign(**{into: sums, "_range": place})[schema.names]

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    within = written(ranged.mapInPandas(add_up, schema), fresh_folder(spark, "ranges"))
    sums = within.groupBy("_range").agg(F.sum(value).alias("_sum"))
    # One row per range: as many as partitions, whatever the table holds.
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_shift"))
    return within.join(F.broadcast(shift), "_range").withColumn(
        into, F.col(into) + F.col("_shift")).drop("_range", "_shift")


def queue_limits(sized: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """Per source the last place in its queue (hash, size, id) that each copy number reaches, as an
    array of structs; null where a copy number reaches none."""
    spark = sized.sparkSession
    waiting = sized.where("size > 0").select(
        "source", "_key", "size", F.coalesce("doc_id", F.lit(0)).alias("_id")).withColumn(
        "_null", F.col("source").isNull().cast("int"))
    queued = running_sum(waiting, ["_null", "source", "_key", "size", "_id"], "size", "_ahead")
    # The running sum goes over all sources; the queues before a source's own are taken off.
    before = running_sum(targets.select("_number", "source", "source_size", "target"),
                         ["_number"], "source_size", "_upto")
    queue = queued.alias("q").join(before.alias("t"),
                                   F.col("q.source").eqNullSafe(F.col("t.source"))).select(
        "q._key", "q.size", "q._id", "t._number", "t.target", "t.source_size",
        (F.col("_ahead") - F.col("_upto") + F.col("source_size")).alias("_queued"))
    copies = queue.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(most)))).select(
        "_number", "_copy", "_key", "size", "_id",
        ((F.col("_queued") + (F.col("_copy") - 1) * F.col("source_size"))
         / F.col("target")).alias("_finish")).where(F.col("_finish").isNotNull())
    order = ["_finish", "_number", "_copy", "_key", "_id"]
    ordered = running_sum(copies, order, "size", "_total")
    # Targets are doubles whose sum may miss a whole or half word by rounding.
    budget = (targets.agg(F.sum("target")).first()[0] or 0.0) + 0.25
    inside = ordered.where(F.col("_total") <= budget)
    reached = inside.groupBy("_number", "_copy").agg(
        F.max(F.struct("_key", "size", "_id")).alias("_last"))
    arrays = reached.groupBy("_number").agg(F.map_from_entries(
        F.collect_list(F.struct("_copy", "_last"))).alias("_reached"))
    limits = targets.join(arrays, "_number", "left")
    return written(limits.select("source", "source_size", "target", "_reached"),
                   fresh_folder(spark, "limits"))


def copies_taken(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                 most: int = MOST, seed: int = SEED) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target`` and ``_copies``, how often the mix
    takes each. Texts stay where they were read."""
    spark = docs.sparkSession
    sized = docs.withColumns({"size": n_words(F.col("text")), "_key": queue_key(seed)})
    slim = written(sized.select("doc_id", "source", "size", "_key"), fresh_folder(spark, "sizes"))
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")),
                             weights, share, most)
    limits = queue_limits(slim, targets, most)
    here = F.struct(F.col("d._key"), F.col("d.size"),
                    F.coalesce(F.col("d.doc_id"), F.lit(0)).alias("_id"))
    n = sum((F.when(here <= F.col("l._reached")[i], 1).otherwise(0) for i in range(1, most + 1)),
            F.lit(0))
    joined = sized.alias("d").join(limits.alias("l"),
                                   F.col("d.source").eqNullSafe(F.col("l.source")), "left")
    return joined.select("d.*", "l.source_size", "l.target",
                         F.when(F.col("d.size") > 0, n).otherwise(0).alias("_copies"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        most: int = MOST, seed: int = SEED) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes of it."""
    taken = copies_taken(docs.select("doc_id", "source", "text"), weights, share, most, seed)
    return taken.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("_copies")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                  most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mixed documents themselves, each as often as it is taken, with their own columns."""
    names = docs.columns
    taken = copies_taken(docs, weights, share, most, seed)
    repeated = taken.where("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*names)
