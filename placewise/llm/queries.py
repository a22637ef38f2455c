"""The operators of this folder over the test tables, by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.llm import (cascade, contamination, jaccard, lattice, merkle, packing, records, rule_ensemble, spelling, substring,
                           token_counts, tool_calls, topk)
from placewise.llm.oracle import SQL  # noqa: F401
from placewise.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

BYTE_BPE = tokenizer_path("byte_bpe_50k.json")
TOKEN_LIMIT = 1024
LEAST_SCORE = 0.7


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out_quality():
    """Documents whose labels are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def held_out_words():
    """Documents whose words are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 1


@query
def op1_quality_rules(spark, sf_dir):
    return cascade.judged(table(spark, sf_dir, "documents"))


@query
def op2_retrieval_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op3_rule_ensemble(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ensemble, counts = rule_ensemble.trained(docs, labels, held_out_quality())
    scores = rule_ensemble.scored(counts, ensemble)
    return scores.select("doc_id", F.coalesce(held_out_quality(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


@query
def op4_substring_dedup(spark, sf_dir):
    found = substring.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.array_join(F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != ""), " ")
    kept = F.coalesce(F.when(F.col("n_removed") > 0, F.col("text")).otherwise(words), F.lit(""))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


@query
def op5_decontamination(spark, sf_dir):
    found = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op6_tool_calls(spark, sf_dir):
    """Each turn of a user is a call, the turn after it its result, and the call two turns before comes first."""
    turns = table(spark, sf_dir, "conversations")
    name = lambda turn: F.concat_ws("-", "conv_id", turn)
    words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    calls = turns.where("role = 'user'").select(
        F.col("conv_id").alias("conversation"), name("turn").alias("call_id"), name(F.col("turn") - 2).alias("after"), F.lit("answer").alias("tool"),
        F.to_json(F.struct("turn", F.when(F.col("text").isNotNull(), words).alias("words"), "text")).alias("arguments"))
    results = turns.where("role = 'assistant'").select(name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    schema = [("answer", "text", "string", True), ("answer", "turn", "integer", True), ("answer", "words", "integer", False)]
    schemas = spark.createDataFrame(schema, "tool string, name string, type string, required boolean")
    found = tool_calls.linked(calls, results, schemas)
    return found.select(F.col("conversation").alias("conv_id"), "call_id", "depth", "n_results", "fault", F.sha2("json", 256).alias("json_sha256"))


@query
def op7_ngram_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_lattice_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scores = lattice.scored(docs, ~held_out_words(), tokenizer_path("piece_bpe_32k.model"))
    return scores.select("doc_id", F.coalesce(held_out_words(), F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_token_counts(spark, sf_dir):
    counts = token_counts.prefix_counts(table(spark, sf_dir, "documents"), BYTE_BPE)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op10_token_records(spark, sf_dir):
    out = work_folder(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), out, BYTE_BPE)
    return records.digests(records.read_records(spark, out))


@query
def op11_merkle_manifest(spark, sf_dir):
    """Where 5 divides the hash of an id, the holder has the text in lower case."""
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return merkle.proofs(merkle.manifest(docs, {"text": F.when(tampered, lower).otherwise(F.col("text"))}))


@query
def op12_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))
