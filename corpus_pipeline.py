"""The corpus pipeline: quality, toxicity, near duplicates, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of the documents.
Each is written as Parquet and read again before the next. Models are fitted on what a stage is given, so each stage is
judged on its own input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.llm import neardup, packing, quality, toxicity
from thalweg.llm.queries import table, tokenizer_path
from thalweg.session import stage_table


def _filtered(docs: DataFrame, score: Column, wanted: Callable[[Column], Column]) -> DataFrame:
    """The rows whose score is wanted, in the columns that they came with."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, score).filter(wanted(F.col(name))).drop(name)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated chance of good quality is at least ``quality.KEEP_FROM``; equal to it counts as kept.

    A null or empty text is judged as an empty one, a null source or language as an empty one; rows that repeat are judged alike and stay or
    go together; without usable labels all stay. An empty table stays empty. Columns come back as they were, whatever their names.
    """
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return _filtered(docs, quality.quality_column(model), lambda s: s["keep"])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of any grade above 0 is below ``toxicity.TOXIC_FROM``; equal to it counts as toxic.

    A null or empty text has no mark and stays; rows that repeat stay or go together; without usable labels all stay. An
    empty table stays empty. Columns come back as they were, whatever their names.
    """
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return _filtered(docs, toxicity.severity_column(model), lambda s: ~s["toxic"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by five-word shingles at 0.8 or more.

    Of rows that repeat a doc_id one stays: that of the smallest text, nulls first, and of equal ones that of the smallest other columns in the
    order of their names. Rows without a doc_id can't be named as copies and all stay, as do texts without words, which are like no other. An
    empty table stays empty.
    """
    found = neardup.near_duplicates(docs, shingle=5, percent=80)
    drop = stage_table(found.filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "dropped")
    named = docs.filter("doc_id is not null").join(drop, "doc_id", "left_anti").select(*docs.columns)
    order = ["text", *sorted(c for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind and "variant" not in kind)]
    one = named.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.struct(*order)).alias("_row"))
    return one.select("_row.*").unionByName(docs.filter("doc_id is null"))


def pack_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens, every window mixed as the sources of what is left of the corpus are.

    A null or empty text is its end id alone; a null source is a source of its own; rows that repeat are packed each; equal deficits go by
    the order of the sources' names. An empty table gives no pieces.
    """
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("packing", pack_mixture),
]

#: Fitted models and token ids can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
