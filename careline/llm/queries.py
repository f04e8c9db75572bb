"""The subpackage's queries over the test tables, ``opN_<name>``, and their SQL where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careline.llm import bpe, chat, decontaminate, divergence, filters, langid, lines, lm_score, quality, sharding, simhash, substring, toxicity
from careline.llm.common import small_batches
from careline.llm.sql import ORACLES, SHARD_BYTES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def sha(text) -> F.Column:
    return F.sha2(text, 256)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document, by a network trained on all of them."""
    scored = lm_score.pseudo_likelihood(table(spark, sf_dir, "documents").select("doc_id", "text"))
    mean = F.when(F.col("lm.n_words") > 0, F.col("lm.log_likelihood") / F.col("lm.n_words"))
    return scored.select("doc_id", "lm.n_words", "lm.log_likelihood", mean.alias("per_word"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, with cutoffs from the labelled ones."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("bigint").alias("n_items"),
                        sha(F.array_join("hits.items", ",")).alias("items_sha256"), "hits.contaminated")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that holds another template's marks, formatted and read back."""
    hostile = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hostile).alias("text")))
    done = chat.format_chats(turns).withColumn("read", chat.read_turns(F.col("formatted")))
    done = done.withColumn("learnt", chat.loss_text(F.col("segments")))
    said = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id", F.size("read").cast("bigint").alias("n_turns"), sha(F.array_join(said, "")).alias("turns_sha256"),
        F.char_length("learnt").cast("bigint").alias("loss_chars"), sha(F.col("learnt")).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the bytes they stand for."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_and_decode(docs, "text", RANKS, public_tokenizers.PATTERN).select("doc_id", "coded.ids", "coded.decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), sha(bpe.ids_text(F.col("ids"))).alias("ids_sha256"),
        sha(F.col("decoded")).alias("decoded_sha256"))


def held_out(doc_id: F.Column) -> F.Column:
    """Documents that language ID never learns from; those without id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def language_model(docs: DataFrame) -> langid.Model | None:
    return langid.train(docs.where(~held_out(F.col("doc_id"))))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    judged = langid.predict(docs.select("doc_id", "text"), language_model(docs))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that stand earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substring.drop_repeated_windows(docs)
    return done.select("doc_id", "deduped.n_words", "deduped.n_removed", sha(F.col("deduped.kept")).alias("kept_sha256"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.assign(table(spark, sf_dir, "documents"), limit=SHARD_BYTES)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier document has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", sha(F.col("text")).alias("kept_sha256"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders, by language."""
    return filters.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between a language's sources, and their own terms."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chance that a document is toxic, after its hidden words are restored."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    judged = toxicity.scores(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_lm_score, op2_quality_rules, op3_decontamination, op4_chat_format, op5_byte_bpe, op6_language_id,
    op7_substring_dedup, op8_sharding, op9_simhash, op10_line_dedup, op11_filter_audit, op12_source_divergence,
    op13_toxicity)}
