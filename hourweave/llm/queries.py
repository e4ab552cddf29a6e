"""The registered corpus queries, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.llm import quality_classifier
from hourweave.llm.common import read_table, word_count
from hourweave.llm.conversation_repair import damaged, repair_conversations
from hourweave.llm.html_text import extract_text
from hourweave.llm.mixing import draw_mix
from hourweave.llm.near_duplicates import group_duplicates
from hourweave.llm.packing import pack
from hourweave.llm.phrase_fingerprint import compare_with_following
from hourweave.llm.quality_rules import judge, rules_sql
from hourweave.llm.repeated_spans import remove_repeats
from hourweave.llm.source_divergence import divergence_sql, source_divergence
from hourweave.llm.token_counts import count_tokens, load_tokenizer
from hourweave.llm.token_files import read_documents, write_token_files
from hourweave.llm.warc_fixity import fixity_report, report_sql, write_warc
from hourweave.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TOKEN_LIMIT = 2048
END_ID = 2
GOOD_FROM = 0.3
ALIKE_PERCENT = 85
MIX_WEIGHTS = (1, 2, 3)
WARC_RECORDS = 2048


def query(f):
    QUERIES[f.__name__] = f
    return f


def held_out() -> Column:
    """One id in five never teaches; neither does a null one."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), folder, path, END_ID)
    return read_documents(spark, folder, load_tokenizer(path).get_vocab_size())


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL["op5_quality_rules"] = rules_sql()


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels.where(~held_out()))
    scored = quality_classifier.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


@query
def op4_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_following(read_table(spark, sf_dir, "documents"))


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_duplicates(read_table(spark, sf_dir, "documents"), percent=ALIKE_PERCENT)


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    drawn = draw_mix(docs, word_count(F.col("text")), MIX_WEIGHTS)
    return drawn.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.size("mix_draws")).alias("taken"), "mix_draws")


@query
def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pack(docs, word_count(F.col("text")))


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a replica in which one bit is wrong in every record whose id leaves 13 over 97."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive = F.floor(F.col("page_id") / WARC_RECORDS)
    folder, replica = scratch_path(spark, "warc"), scratch_path(spark, "warc-replica")
    index = write_warc(pages, replica, archive, damaged=F.col("page_id") % 97 == 13, compress=True, pristine=folder)
    return fixity_report(index, folder, replica, compress=True).withColumnRenamed("id", "page_id")


ORACLE_SQL["op2_warc_fixity"] = report_sql(WARC_RECORDS, "page_id % 97 = 13")


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents").select("text", "lang", "source"))


ORACLE_SQL["op11_source_divergence"] = divergence_sql()


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(read_table(spark, sf_dir, "conversations")))


@query
def op13_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
