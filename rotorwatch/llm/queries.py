"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorwatch.llm import ann, chat, counts, divergence, exact, infill, jaccardjoin, mixing, nearcopies, packing, repeats, tokenfiles, toxicity
from rotorwatch.llm.common import table, tokenizer_file

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"
END_ID = 1


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.read_chats(chat.format_chats(turns.unionByName(more)))


def quality_weight(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``_quality``: 2 where labelled good, 0.5 where labelled bad, 1 where not labelled."""
    by_id = labels.groupBy(F.col("doc_id").alias("_labelled")).agg(F.max("quality").alias("_q"))
    weight = F.when(F.col("_q") == 1, 2.0).when(F.col("_q") == 0, 0.5).otherwise(1.0)
    return docs.join(by_id, F.col("doc_id") == F.col("_labelled"), "left").withColumn("_quality", weight)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    mixed = mixing.mix(quality_weight(docs, table(spark, sf_dir, "labels")), quality=F.col("_quality"), size="size")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(WORDS), END_ID)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file(BYTES))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenfiles.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file(WORDS), END_ID)
    return tokenfiles.read_token_files(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return left.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccardjoin.jaccard_join(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents"))
    digests = (F.sha2(c, 256) for c in (F.col("output"), infill.restored()))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *(d.alias(a) for d, a in zip(digests, ("output_sha256", "restored_sha256"), strict=True)))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_mixing": op2_mixing,
    "op3_packing": op3_packing,
    "op4_nearest_vectors": op4_nearest_vectors,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_source_divergence": op13_source_divergence,
}
