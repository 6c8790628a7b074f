"""The registered queries of this package, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outagelens.session import configure
from outagelens.sources.scratch import scratch_folder

from . import (
    bit_sliced,
    bottom_k,
    bpe,
    chat_template,
    collocations,
    golay_dedup,
    language,
    license_scan,
    mixing,
    prefix_trie,
    sharding,
    token_counts,
    toxicity,
)
from .common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: query(prepare(configure(spark)), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


@register("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    """Tokens of every document; the cache starts empty, as the folder is the run's own."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, token_counts.ByteBpe.public(), scratch_folder(spark, "token-cache"))


@register("op3_golay_dedup")
def op3_golay_dedup(spark, sf_dir):
    return golay_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@register("op6_bpe_round_trip")
def op6_bpe_round_trip(spark, sf_dir):
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op7_byte_shards")
def op7_byte_shards(spark, sf_dir):
    sized = sharding.sized_documents(table(spark, sf_dir, "documents"))
    placed = sharding.byte_shards(sized, ("doc_id", "text_crc32", "size"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op8_bottom_k")
def op8_bottom_k(spark, sf_dir):
    return bottom_k.compare_with_next(table(spark, sf_dir, "documents"))


@register("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.identify(docs, model)


@register("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score_documents(docs, lexicon)


@register("op1_mixing", mixing.mixture_sql())
def op1_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


@register("op4_bit_sliced", bit_sliced.TOP_SQL)
def op4_bit_sliced(spark, sf_dir):
    return bit_sliced.top_products(table(spark, sf_dir, "embeddings"))


@register("op5_chat_template", chat_template.DIGEST_SQL)
def op5_chat_template(spark, sf_dir):
    rows = chat_template.with_control_conversation(table(spark, sf_dir, "conversations"))
    return chat_template.read_back(chat_template.format_conversations(rows))


@register("op11_license_scan")
def op11_license_scan(spark, sf_dir):
    return license_scan.license_summary(license_scan.scan(table(spark, sf_dir, "documents")))


@register("op12_prefix_trie", prefix_trie.trie_sql())
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@register("op13_collocations", collocations.collocations_sql())
def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))
