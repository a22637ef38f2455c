"""A corpus from documents to packed sequences, stage by stage.

Each stage takes all rows that the one before kept, as a table written to the shared
folder. The packing at the end has no SQL form, so there is no ORACLE_SQL.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.llm import contamination, jaccard, packing, rule_ensemble, substring
from placewise.llm.queries import LEAST_SCORE, held_out_quality, table
from placewise.session import work_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds good; it learns from their labels but for the held-out ones."""
    return rule_ensemble.good(docs, table(spark, sf_dir, "labels"), LEAST_SCORE, held_out_quality())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies."""
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; texts that lose nothing stay as they are.

    Documents that lose all their words go.
    """
    found = substring.without_repeats(docs)
    fields = {f.name: F.col(f"rest.`{f.name}`") for f in found.schema["rest"].dataType if f.name in docs.columns}
    found = found.where("n_removed = 0 OR n_removed < n_words")
    if "n_chars" in fields:
        fields["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(fields["n_chars"])
    columns = {"doc_id": F.col("doc_id"), "text": F.col("text")} | fields
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.packed(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages),
          ("benchmark decontamination", decontaminated), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; what a stage kept is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = work_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(kept.schema).parquet(f"{folder}/{number}")
    return docs
