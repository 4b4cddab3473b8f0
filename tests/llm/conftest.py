import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def frame(spark):
    """documents with a few more columns, whose names the operators use too."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", len(t or ""), "x", "y", 1.0) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, DOCS + ", fingerprint string, shard string, score double")

    return make


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


#: Empty, null, short, long and repeated texts.
EDGES = ["", None, "a", " ", "\n\t", "é", "word " * 30_000, "x" * 50_000, "same text twice", "same text twice", "'s 'll don't <|endoftext|> 12²", "　漢字 😀"]
