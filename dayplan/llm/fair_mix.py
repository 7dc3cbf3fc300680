"""Mixing sources to target weights by weighted fair queueing.

Each source is a stream of its documents in hashed order, repeated when its target is above its
size. A document's virtual finish time is the stream's words up to and with it, divided by the
source's target. All streams are merged in order of finish time and cut at the total budget.

Running sums are formed in two levels, over slices of bounded size and over the slices' totals,
so neither a source with a third of all rows nor the global order ends in one task. With n rows,
there are about sqrt(n) slices of sqrt(n) rows: both levels grow alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayplan.llm.shared import Scratch
from dayplan.operators.dense_index import dense_index

_TOP = 1 << 32


def word_count(text: str) -> Column:
    r"""Runs of other characters than space and \x09-\x0D."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, limit: float = 3.0, cycle: int = 3) -> DataFrame:
    """(source, source_size, rank, weight, target) from (source, source_size), one row per source.

    Sources in order of code point, null last, weigh 1, 2, ..., ``cycle``, 1, ... They share all
    words by weight; a target stops at ``limit`` times its source's size and the excess is shared
    again. Each round settles every source above its share, with two sums from the cluster.
    """
    ranked, _ = dense_index(
        sizes.withColumn("_null", F.col("source").isNull().cast("int")), "_null", "source", name="_rank"
    )
    scratch = Scratch(sizes.sparkSession, "targets")
    ranked = scratch.write(
        ranked.select("source", "source_size", F.col("_rank").alias("rank"), (F.col("_rank") % cycle + 1).alias("weight"),
                      (F.col("source_size") * F.lit(limit)).alias("_most")), "sources"
    )
    level = None
    budget = ranked.agg(F.sum("source_size")).first()[0] or 0
    while True:
        full = F.lit(False) if level is None else F.col("_most") <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum(F.when(~full, F.col("weight"))).alias("w"),
            F.sum(F.when(full, F.col("_most"))).alias("m"), F.count(F.when(full, 1)).alias("n"),
        ).first()
        if not row["w"]:
            break
        share = (budget - (row["m"] or 0.0)) / row["w"]
        if level is not None and share <= level:
            break
        level = share
    target = F.col("_most") if level is None else F.least(F.col("_most"), F.col("weight") * F.lit(float(level)))
    return ranked.select("source", "source_size", "rank", "weight", target.cast("double").alias("target"))


def _running(df: DataFrame, group: list[str], slice_: str, order: list[str], size: str, out: str) -> DataFrame:
    """Inclusive running sum of ``size`` in ``order`` within ``group``; ``slice_`` cuts each group in order."""
    totals = df.groupBy(*group, slice_).agg(F.sum(size).alias("_n"))
    before = totals.withColumn(
        "_before",
        F.coalesce(F.sum("_n").over(
            Window.partitionBy(*group).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).drop("_n")
    inside = Window.partitionBy(*group, slice_).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_in", F.sum(size).over(inside)).join(before, [*group, slice_]).withColumn(
        out, F.col("_in") + F.col("_before")).drop("_in", "_before")


def fair_mix(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    limit: float = 3.0, seed: str = "mix",
) -> DataFrame:
    """What the mix takes of each row: (doc_id, source, size, source_size, target, taken, key).

    ``taken`` counts the words of all copies that finish within the budget; the copy that crosses
    it is cut there. Order within a stream is md5(seed:pass:doc_id:md5 of the text), so rows without an
    id, or with the same one, are spread too; rows that agree in all are exchangeable. Rows without words take nothing. A null doc_id hashes as empty text.
    ``key`` is xxhash64 of the text. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    rows, n_rows = scratch.write_counting(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"),
                    F.xxhash64(F.col(text)).alias("key"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_text"), F.monotonically_increasing_id().alias("_uid")), "rows"
    )
    slice_rows = max(1, math.isqrt(n_rows))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    targets = scratch.write(source_targets(sizes.select("source", "source_size"), limit), "targets")
    facts = targets.join(
        sizes.select(F.col("source").alias("_s"), "_rows"), F.col("source").eqNullSafe(F.col("_s"))
    ).select(
        F.col("rank").alias("_stream"), F.col("source").alias("_s"), "source_size", "target",
        F.ceil(F.col("_rows") / F.lit(slice_rows)).alias("_slices"),
        F.ceil(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("int").alias("_passes"),
    )
    facts = scratch.write(facts, "facts")
    known = rows.join(facts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    copies = known.where("size > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0), F.col("_passes") - 1)))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("_pass"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("_text")))
    copies = copies.withColumn("_key", key).withColumn(
        "_slice",
        F.col("_pass") * F.col("_slices")
        + F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint") * F.col("_slices") / F.lit(_TOP)),
    )
    timed = _running(
        copies.select("_uid", "_stream", "_slice", "_pass", "_key", "size", "target", "doc_id"),
        ["_stream"], "_slice", ["_key", "size", "_uid"], "size", "_sum",
    )
    finish, count = scratch.write_counting(
        timed.select("_uid", "_stream", "_pass", "_key", "size", (F.col("_sum") / F.col("target")).alias("_finish")),
        "finish",
    )
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    parts = max(1, -(-count // slice_rows))
    queue = _running(
        finish.withColumn("_part", F.floor(F.col("_finish") * F.lit(parts)).cast("bigint")),
        [], "_part", ["_finish", "_stream", "_pass", "_key", "size", "_uid"], "size", "_total",
    )
    took = queue.where(F.col("_total") - F.col("size") < F.lit(budget)).groupBy("_uid").agg(
        F.sum(F.least(F.col("size"), F.lit(budget) - F.col("_total") + F.col("size"))).alias("taken")
    )
    return known.join(took, "_uid", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        "key",
    )


def mixed_rows(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **settings,
) -> DataFrame:
    """The mix itself: rows of ``docs``, with their columns as they are, as often as they are taken.

    A copy that the budget cuts counts as a whole one. Rows meet their counts by id, source and
    hash of the text; where rows repeat, those that agree in all three are numbered first.
    """
    scratch = Scratch(docs.sparkSession, "mixed")
    took = scratch.write(
        fair_mix(docs, doc_id, source, text, **settings).where("taken > 0").select(
            F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"), F.col("key").alias("t_key"),
            F.ceil(F.col("taken") / F.col("size")).cast("int").alias("copies")), "taken")
    row = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("d"), F.col(source).alias("s"), F.xxhash64(F.col(text)).alias("h"))
    same = F.col("d").eqNullSafe(F.col("t_id")) & F.col("s").eqNullSafe(F.col("t_source")) & (F.col("h") == F.col("t_key"))
    again = took.groupBy("t_id", "t_source", "t_key").count().where("count > 1")
    if not again.isEmpty():
        number = F.row_number().over(Window.partitionBy("t_id", "t_source", "t_key").orderBy(F.desc("copies")))
        took = took.withColumn("t_nth", number)
        row = row.withColumn("nth", F.row_number().over(Window.partitionBy("d", "s", "h").orderBy("h")))
        same = same & (F.col("nth") == F.col("t_nth"))
    return row.join(took, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
