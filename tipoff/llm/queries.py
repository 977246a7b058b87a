"""The registered queries of this package, and the SQL some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import decontamination, dialogue, embeddings, html, jaccard, language_model, lines, manifest, packing, passages, subwords, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    text = html.main_text(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": embeddings.op1_embedding_dedup,
    "op2_packing": packing.op2_packing,
    "op3_lm_score": language_model.op3_lm_score,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_warc": warc.op5_warc,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_html_text": op7_html_text,
    "op8_substring_dedup": passages.op8_substring_dedup,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_sentencepiece": subwords.op11_sentencepiece,
    "op12_merkle_manifest": manifest.op12_merkle_manifest,
    "op13_conversation_repair": dialogue.op13_conversation_repair,
}

ORACLE: dict[str, str] = {"op5_warc": warc.ORACLE_SQL}
