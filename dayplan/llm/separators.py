"""Document boundaries of flat token files that have no index.

A file is nothing but ids. Blocks of ids are read independently, each searched for the
end-of-document id at once in numpy. Documents that cross blocks are stitched by a prefix scan
over runs of blocks and over the blocks of a run: the count of ends before and the place of the last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayplan.llm.files import new_file, open_file
from dayplan.llm.shared import Scratch
from dayplan.llm.tokens import TOKENIZER, encoder, text_runs

END = 50256
BLOCK_IDS = 1 << 20
RUN_BLOCKS = 1024


def write_flat(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
    end_id: int = END, dtype: str = "<u2", scratch: Scratch | None = None,
) -> DataFrame:
    """Write each partition's ids to a flat file, ``end_id`` behind every document.

    Returns the stored order of the documents: (part, name, row, doc_id) with row = 0, 1, ... in a file.
    Nothing is shuffled.
    """
    scratch = scratch or Scratch(docs.sparkSession, "flat")
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        coder = encoder(tokenizer, dtype, added=False)
        tail = np.array([end_id], coder.dtype).tobytes()
        name, sink = new_file(folder, pid)
        at = 0
        with sink:
            for frame in batches:
                texts = frame["text"].tolist()
                for a, b in text_runs(texts):
                    for found in coder.ids([t if isinstance(t, str) else "" for t in texts[a:b]]):
                        sink.write(found + tail)
                yield pd.DataFrame({
                    "part": pid, "name": name, "row": np.arange(at, at + len(texts)), "doc_id": frame["doc_id"].astype("Int64"),
                })
                at += len(texts)

    return scratch.write(read.mapInPandas(run, "part int, name string, row bigint, doc_id bigint"), "order")


def scan_files(
    files: DataFrame, folder: str, end_id: int = END, dtype: str = "<u2", block_ids: int = BLOCK_IDS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """(name, row, start, n_tokens, closed): every document of the files named in ``files``.

    ``n_tokens`` leaves out the end id, ``row`` counts from 0 in each file. Ids behind the last end
    form a document that is not closed; a file ends its last document. An empty file has none.
    A file that is no whole number of ids is an error.
    """
    spark = files.sparkSession
    scratch = scratch or Scratch(spark, "separators")
    step = np.dtype(dtype).itemsize
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            sizes = []
            for name in frame["name"]:
                with open_file(folder, name) as source:
                    sizes.append(source.size())
            if any(size % step for size in sizes):
                raise ValueError("a file does not hold whole ids")
            yield pd.DataFrame({"name": frame["name"], "ids": [size // step for size in sizes]})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for name, block, ids in zip(frame["name"], frame["block"], frame["ids"]):
                first = int(block) * block_ids
                count = min(block_ids, int(ids) - first)
                with open_file(folder, name) as source:
                    found = np.frombuffer(source.read_at(count * step, first * step), dtype)
                ends = np.flatnonzero(found == end_id) + first
                yield pd.DataFrame({
                    "name": name, "block": int(block), "nth": np.arange(len(ends)), "at": ends,
                    "last": pd.array([pd.NA, *ends[:-1]][: len(ends)], "Int64"),
                })

    sized = scratch.write(
        files.select("name").distinct().repartition(n).mapInPandas(measure, "name string, ids bigint"), "files"
    )
    blocks = sized.where("ids > 0").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(ids - 1) div {block_ids}"))))
    ends = scratch.write(
        blocks.repartition(n).mapInPandas(search, "name string, block bigint, nth bigint, at bigint, last bigint"), "ends"
    )
    summary = ends.groupBy("name", "block").agg(F.count("*").alias("n"), F.max("at").alias("top"))
    # runs of blocks, then blocks within a run: no window holds all blocks of a large file
    summary = scratch.write(summary.withColumn("run", F.expr(f"block div {RUN_BLOCKS}")), "summary")
    order = Window.partitionBy("name").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = summary.groupBy("name", "run").agg(F.sum("n").alias("r_n"), F.max("top").alias("r_top")).select(
        F.col("name").alias("r_name"), F.col("run").alias("r_run"),
        F.coalesce(F.sum("r_n").over(order), F.lit(0)).alias("r_before"),
        F.coalesce(F.max("r_top").over(order), F.lit(-1)).alias("r_carry"))
    inside = Window.partitionBy("name", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.withColumns({
        "i_before": F.coalesce(F.sum("n").over(inside), F.lit(0)), "i_carry": F.coalesce(F.max("top").over(inside), F.lit(-1)),
    }).join(runs, (F.col("name") == F.col("r_name")) & (F.col("run") == F.col("r_run"))).select(
        F.col("name").alias("c_name"), F.col("block").alias("c_block"), (F.col("i_before") + F.col("r_before")).alias("before"),
        F.greatest("i_carry", "r_carry").alias("carry"))
    start = F.coalesce(F.col("last"), F.col("carry")) + 1
    closed = ends.join(carried, (F.col("name") == F.col("c_name")) & (F.col("block") == F.col("c_block"))).select(
        "name", (F.col("before") + F.col("nth")).alias("row"), start.alias("start"),
        (F.col("at") - start).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    whole = summary.groupBy(F.col("name").alias("c_name")).agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    tail = sized.join(whole, F.col("name") == F.col("c_name"), "left").select(
        "name", F.coalesce("n", F.lit(0)).alias("row"), (F.coalesce("top", F.lit(-1)) + 1).alias("start"), "ids"
    ).where("start < ids").select("name", "row", "start", (F.col("ids") - F.col("start")).alias("n_tokens"),
                                  F.lit(False).alias("closed"))
    return closed.unionAll(tail)


def token_counts(docs: DataFrame, **names) -> DataFrame:
    """(doc_id, part, row, start, n_tokens) of every row of ``docs``: written flat, then found by the scan.

    A null text is an empty document. The end id is a token that the vocabulary adds; a text that
    spells it out is encoded letter by letter here, so only the ends of documents are ends.
    """
    scratch = Scratch(docs.sparkSession, "separators")
    folder = f"{scratch.root}/ids"
    order = write_flat(docs, folder, scratch=scratch, **names)
    found = scan_files(order.select("name"), folder, scratch=scratch)
    return found.join(order, ["name", "row"]).select("doc_id", "part", "row", "start", "n_tokens")
