"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. `run` writes
what a stage returns to the shared scratch folder and reads it back as the next one's input, so
that a lost executor costs the current stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from outagelens.llm import bpe, golay_dedup, language, mixing, toxicity
from outagelens.llm.common import kept, prepare, table
from outagelens.session import configure
from outagelens.sources.scratch import job_scratch, scratch_folder


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The lexicon is learned from the labelled ones.

    Like all stages: repeated rows are judged alike, an empty table gives no rows, columns may have any names.
    Null and empty texts are not toxic and stay.
    """
    prepare(configure(spark))
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language, or plainly in another than they claim, go; null and empty texts are such."""
    prepare(configure(spark))
    return language.drop_rejected(docs, language.fit(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints linked at 3 or fewer bits the document of the smallest id stays; null and empty texts are one group."""
    prepare(configure(spark))
    return golay_dedup.drop_near_duplicates(docs)


def vocabulary() -> str:
    """The tokenizer by whose tokens the corpus is mixed and encoded."""
    return public_tokenizers.path("word_bpe_49k.json")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that tokens meet the target shares of sources, languages and topics; null ones are values of their own.

    Tokens are those the encoding stage makes of the whole texts, not an estimate.
    """
    prepare(configure(spark))
    return mixing.sample_to_targets(docs, weigh=bpe.count_column(vocabulary()))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the ids, and digest of the text they decode to; a null text is empty."""
    prepare(configure(spark))
    return bpe.round_trip(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_stage),
    ("language", language_stage),
    ("near_duplicates", dedup_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: No SQL can express the learned grammar, the automata or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one.

    What the stages store on the way is removed at the end, their last result stays.
    """
    docs = table(prepare(configure(spark)), sf_dir, "documents")
    path = scratch_folder(spark, "corpus")
    with job_scratch(spark, "corpus-stages"):
        for name, stage in STAGES[:-1]:
            docs = kept(stage(spark, docs, sf_dir), f"corpus-{name}")
        docs = STAGES[-1][1](spark, docs, sf_dir)
        docs.write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)
