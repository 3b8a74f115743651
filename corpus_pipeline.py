"""The corpus pipeline: five stages over ``documents``, each by one operator of ``llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared scratch folder and rereads it as the next stage's docs. All but the
last return the columns of ``documents``:

1. quality rules: documents that the rules reject go;
2. line dedup: later occurrences of repeated three-line windows go, and documents that
   nothing is left of;
3. near duplicates: one document of each class stays, that with the least key;
4. mix: each document as often as the mix takes it;
5. packing: one row for each piece, with its sequence and place.

Nulls, empty texts, ties, repeated rows and empty tables are treated as the operators'
docstrings say; columns beyond those of ``documents`` pass through stages 1 to 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transitlake.llm import best_fit, budget_mix, line_windows, order_minhash, quality_rules
from transitlake.llm.tables import prepare, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_windows.lines_removed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return budget_mix.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("mix", mix), ("packing", packing)]

# The stages' binomial tests, sketches and tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
