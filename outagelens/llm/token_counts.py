"""Token counts with a cache keyed by digests.

A count depends on the text and on the tokenizer only. Both are named by digests: SHA-256 of
the normalised content (null read as empty; the bytes are otherwise left alone, since any other
change could change the count) and SHA-256 of the tokenizer's definition. Stored counts are
found by a join; only distinct texts without one are encoded, and their counts are appended.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import whole_text

CACHE_SCHEMA = "tokenizer_digest string, content_digest binary, n_tokens long"
SPECIAL = "<|endoftext|>"


def content_digest(text: Column | str = "text") -> Column:
    """32 bytes that name the normalised content."""
    return F.unhex(F.sha2(F.encode(whole_text(text), "UTF-8"), 256))


class ByteBpe:
    """A byte-level BPE tokenizer, its version digest, and a counter for whole texts.

    ``ranks_path`` is the rank file of the vocabulary and ``special`` the strings that stand
    for one token each wherever they occur in a text, as the tokenizers library reads them.
    ``definition_path`` is the same tokenizer as a file of that library. It is several times
    slower, and counts the texts that the other encoder refuses (very long white space).
    """

    def __init__(self, ranks_path: str, pattern: str, special: dict[str, int], definition_path: str | None = None):
        self.ranks_path = ranks_path
        self.pattern = pattern
        self.special = dict(special)
        self.definition_path = definition_path

    @classmethod
    def public(cls, name: str = "byte_bpe_50k") -> ByteBpe:
        """The vocabulary of the public tokenizer folder, with its end-of-text string."""
        import public_tokenizers

        ranks, definition = (public_tokenizers.path(f"{name}.{kind}") for kind in ("tiktoken", "json"))
        return cls(ranks, public_tokenizers.PATTERN, {SPECIAL: 50256}, definition)

    def digest(self) -> str:
        """Names the vocabulary, the split pattern and the special strings."""
        found = hashlib.sha256()
        with open(self.ranks_path, "rb") as file:
            for block in iter(lambda: file.read(1 << 20), b""):
                found.update(block)
        found.update(repr((self.pattern, sorted(self.special.items()))).encode())
        return found.hexdigest()

    def counter(self) -> Callable[[str], int]:
        import tiktoken

        with open(self.ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding(
            "byte-bpe", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens=self.special
        )
        library: list = []

        def count(text: str) -> int:
            try:
                return len(encoding.encode(text, allowed_special="all"))
            except ValueError:
                if not self.definition_path:
                    raise
                if not library:
                    from tokenizers import Tokenizer

                    library.append(Tokenizer.from_file(self.definition_path))
                return len(library[0].encode(text, add_special_tokens=False).ids)

        return count


_COUNTERS: dict[str, Callable[[str], int]] = {}


def counter_of(tokenizer: ByteBpe, digest: str) -> Callable[[str], int]:
    """This process's counter, made once.

    A column function must reach it through this module: what it names itself is copied into
    each task.
    """
    if digest not in _COUNTERS:
        _COUNTERS[digest] = tokenizer.counter()
    return _COUNTERS[digest]


def _count_udf(tokenizer: ByteBpe) -> Callable[[Column], Column]:
    key = tokenizer.digest()

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = counter_of(tokenizer, key)
        for texts in batches:
            yield pd.Series([counter(text) for text in texts], dtype="int64")

    return count


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; none if the folder is new."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def fill_cache(texts: DataFrame, tokenizer: ByteBpe, cache_path: str, text: str = "text") -> None:
    """Encode the distinct texts that have no stored count, and append their counts.

    Copies are merged before the shuffle. A run that is repeated after a failure encodes only
    what is still missing; counts stored twice are equal and are merged when they are read.
    """
    version = tokenizer.digest()
    known = read_cache(texts.sparkSession, cache_path)
    known = known.filter(F.col("tokenizer_digest") == version).select("content_digest")
    distinct = (
        texts.select(content_digest(texts[text]).alias("content_digest"), whole_text(texts[text]).alias("_text"))
        .groupBy("content_digest")
        .agg(F.first("_text").alias("_text"))
    )
    misses = distinct.join(known, "content_digest", "left_anti")
    counted = misses.select(
        F.lit(version).alias("tokenizer_digest"),
        "content_digest",
        _count_udf(tokenizer)(F.col("_text")).alias("n_tokens"),
    )
    counted.write.mode("append").parquet(cache_path)


def count_tokens(
    docs: DataFrame, tokenizer: ByteBpe, cache_path: str, over: int = 1024, key: str = "doc_id"
) -> DataFrame:
    """One row per document: the key, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > over).

    A null text counts as empty (0 bytes, 0 tokens). Repeated rows and repeated or null keys
    keep a row each. Texts are counted whole. Other columns of the table are ignored, whatever
    their names. An empty table gives no rows.
    """
    fill_cache(docs, tokenizer, cache_path)
    stored = read_cache(docs.sparkSession, cache_path)
    stored = stored.filter(F.col("tokenizer_digest") == tokenizer.digest())
    stored = stored.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    rows = docs.select(
        docs[key],
        F.octet_length(whole_text(docs["text"])).cast("long").alias("n_bytes"),
        content_digest(docs["text"]).alias("content_digest"),
    )
    found = rows.join(stored, "content_digest", "left")
    return found.select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
