import pytest

from outagelens.llm.common import prepare


@pytest.fixture(scope="module")
def ready(spark):
    """The session with the package's settings."""
    return prepare(spark)


@pytest.fixture(scope="module")
def documents(ready):
    """Documents with nulls, empty, blank, very long and repeated texts, and columns of clashing names."""
    words = [f"w{i * 7919 % 997}" for i in range(30_000)]
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, " \t\n ", "de", "a"),
        (6, " ".join(words), "en", "a"),
        (None, "a text without an id", None, "c"),
        (7, "Éa ñ 你好 <|endoftext|> 😀 ͅΣς", "fr", "c"),
    ]
    extra = "lit 1 fp root shard slot _range weight score found text_crc32 id part n_tokens".split()[2:]
    df = ready.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in extra:
        if name not in df.columns:
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="module")
def no_documents(documents):
    return documents.limit(0)
