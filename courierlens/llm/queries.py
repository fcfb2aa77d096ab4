"""The operators over their whole tables, with production parameters, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from courierlens.llm.bpe import encoded_and_decoded
from courierlens.llm.chat import SQL as CHAT_SQL
from courierlens.llm.chat import formatted_conversations
from courierlens.llm.common import table
from courierlens.llm.cover import near_vectors
from courierlens.llm.html import extract
from courierlens.llm.minhash import NearParams, near_duplicates
from courierlens.llm.packing import PackParams, added_tokens, pack
from courierlens.llm.ppm import scores
from courierlens.llm.quality import quality
from courierlens.llm.toxicity import toxicity
from courierlens.llm.trie import SQL as TRIE_SQL
from courierlens.llm.trie import prefix_trie
from courierlens.llm.wand import SQL as SEARCH_SQL
from courierlens.llm.wand import search_own
from courierlens.llm.warc import archived
from courierlens.llm.whiten import whitened


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoded_and_decoded(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


def op5_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_own(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearParams(words=2))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pack_params() -> PackParams:
    """The rank file holds the vocabulary of byte_bpe_50k.json; the tests hold its ids against that file's.

    The added tokens are in the json only.
    """
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return PackParams(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added=added)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), pack_params())


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted_conversations(table(spark, sf_dir, "conversations"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_main_text,
        op2_byte_bpe,
        op3_warc,
        op4_ppm,
        op5_top_k_search,
        op6_toxicity,
        op7_near_duplicates,
        op8_quality,
        op9_packing,
        op10_cover_tree,
        op11_chat_examples,
        op12_prefix_trie,
        op13_whitening,
    )
}

ORACLES: dict[str, str] = {"op5_top_k_search": SEARCH_SQL, "op11_chat_examples": CHAT_SQL, "op12_prefix_trie": TRIE_SQL}
