"""The training corpus, stage by stage: filter, deduplicate, decontaminate, mix, write token files.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of documents. Nulls are allowed in every column, rows may repeat, tables may be
empty, and further columns pass through unchanged:

toxicity        rejects rows scoring 0.5 or more; null and empty texts are kept.
near_duplicates keeps one row of each class of linked texts, the one with the least doc_id (null
                last); of rows that repeat it, one. Texts without words are all kept.
decontaminate   rejects rows in which a benchmark window occurs.
mix             repeats each row as often as the mix takes it whole, and once more where it takes a
                part, so the budget is overrun by less than one document; rows it does not reach go,
                rows without words too.
tokens          writes the Simple-8b files and returns what is read back from them, a row per
                document and copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayplan.llm import chosen_path, deobfuscate, fair_mix, labels, simple8b, suffix
from dayplan.llm.shared import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and reject toxic ones."""
    model = deobfuscate.fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=labels.fold("doc_id", 5) != 0)
    return deobfuscate.remove_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of five-word Jaccard similarity 0.8 or more."""
    return chosen_path.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject rows that hold a window of ten benchmark words."""
    return suffix.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in the proportion of the sources' target weights, repeats included."""
    return fair_mix.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus, and each document as read back."""
    return simple8b.token_round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

ORACLE_SQL = None  # the toxicity model and the tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "corpus")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
