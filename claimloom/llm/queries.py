"""The operators over the given tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm.alignment import align_tokenizers
from claimloom.llm.chat import format_turns, read_back
from claimloom.llm.common import read_table
from claimloom.llm.kneser_ney import classify
from claimloom.llm.line_dedup import drop_repeated_lines
from claimloom.llm.merkle import fingerprint_documents
from claimloom.llm.minhash import near_duplicates
from claimloom.llm.mixing import MIX_SQL, mix_sources
from claimloom.llm.oracles import CHAT_SQL, MERKLE_SQL, NEAR_SQL, WARC_SQL
from claimloom.llm.packing import digest_pieces, pack_documents
from claimloom.llm.rules import COUNTS, judge, learn_rules, statistics
from claimloom.llm.scanning import digest_spans, scan_documents
from claimloom.llm.sharding import shard_documents
from claimloom.llm.spelling import spelling_variants
from claimloom.llm.warc import archive_pages
from claimloom.session import stored


def op1_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines", "removed_words")


def op2_min_max_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2)


def op3_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


def op4_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_pieces(pack_documents(read_table(spark, sf_dir, "documents")))


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(statistics(read_table(spark, sf_dir, "documents")), "quality-statistics")
    rules = learn_rules(stats, read_table(spark, sf_dir, "labels"))
    return judge(stats, rules).select("doc_id", *COUNTS[:5], "base_failed", "kept")


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op7_jump_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "n_words", "perplexity", "kept")


def op9_token_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    control = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    return read_back(format_turns(turns))


def op10_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_spans(scan_documents(read_table(spark, sf_dir, "documents")))


def op11_trie_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read_table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read_table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_chunks,
        op2_min_max_hash,
        op3_sainte_lague,
        op4_bm25_packing,
        op5_decision_list,
        op6_merkle,
        op7_jump_hash,
        op8_kneser_ney,
        op9_token_chat,
        op10_secret_automaton,
        op11_trie_frontier,
        op12_pair_bitmaps,
        op13_warc,
    )
}
ORACLE = {"op2_min_max_hash": NEAR_SQL, "op3_sainte_lague": MIX_SQL, "op6_merkle": MERKLE_SQL, "op9_token_chat": CHAT_SQL, "op13_warc": WARC_SQL}
