"""Registered queries of the training-data operators, over the whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isospread.llm import (
    align,
    decontam,
    html,
    jaccard,
    linededup,
    lm,
    maxscore,
    mix,
    neardup,
    repair,
    substring,
    tokens,
    toxicity,
)
from isospread.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def tokenizer_file(name: str = TOKENIZER) -> str:
    """A vocabulary on this machine; it is sent to the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _crc(doc_id: str = "doc_id") -> Column:
    """Of the id as text; a null id counts as 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in a mix of all sources."""
    mixed = mix.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by deleted interpolation."""
    scored = lm.score(_documents(spark, sf_dir), lm.crc_split(), ["doc_id"])
    return scored.withColumn("held_out", _crc() % 7 == 2)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    docs = _documents(spark, sf_dir)
    index = toxicity.fit(docs, _table(spark, sf_dir, "labels"), _crc() % 5 != 0)
    scored = toxicity.score(docs, index, ["doc_id"])
    return scored.select(
        "doc_id", (_crc() % 5 == 0).alias("held_out"), "score", "predicted", "evidence"
    )


def op4_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every twentieth vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of passages that repeat."""
    cut = substring.remove_repeats(_documents(spark, sf_dir), ["doc_id"])
    return cut.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in windows of benchmark items."""
    found = decontam.find_items(
        _documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that an earlier line nearly equals."""
    cut = linededup.dedup_lines(_documents(spark, sf_dir), ["doc_id"])
    return cut.select(
        "doc_id",
        "n_lines",
        "n_removed",
        "removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of similar documents and its number of links."""
    found = jaccard.similar(_documents(spark, sf_dir))
    return found.select("doc_id", "class_id", "copy_id", "n_links")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, from its stored prefix counts."""
    counted = tokens.count_prefixes(_documents(spark, sf_dir), tokenizer_file(), ["doc_id"])
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    found = html.extract(pages, html.train(pages), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens of every document."""
    return align.align_tokens(_documents(spark, sf_dir), *map(tokenizer_file, ALIGNED))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after damage."""
    return repair.repair_damaged(_table(spark, sf_dir, "conversations"))


def op13_sketch_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies."""
    return neardup.near_copies(_documents(spark, sf_dir))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_lm_scores": op2_lm_scores,
    "op3_toxicity": op3_toxicity,
    "op4_maxscore_topk": op4_maxscore_topk,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_line_dedup": op7_line_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_counts": op9_token_counts,
    "op10_main_text": op10_main_text,
    "op11_align_tokenizers": op11_align_tokenizers,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_sketch_near_copies": op13_sketch_near_copies,
}
