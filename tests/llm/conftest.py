import pytest

from tidemill.llm.workers import share_package

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    share_package(spark)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture
def odd(spark):
    """Null, empty, blank, short, long and repeated texts; null and repeated ids; columns with names of results."""
    long = " ".join(f"word{i % 977} and other{i % 31}" for i in range(60000))
    rows = [
        (1, None, None, "a"), (2, "", "en", None), (3, " \n\t ", "en", "b"), (4, "One", "fr", "c"), (4, "One", "fr", "c"),
        (5, long, "en", "d"), (None, "no id here, but eight words of text", "de", "e"), (6, "naïve <|endoftext|> café\r\n", "fr", "f"),
        (7, "one", None, "g"), (8, "a b c d", "en", "h"), (9, "x y a b c d", "en", "h"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    extra = {c: "kept" for c in ("score", "n_tokens", "shard", "row", "piece", "n", "node", "key", "kept", "spans", "license")}
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, schema).withColumns({k: F.lit(v) for k, v in extra.items()})


@pytest.fixture
def none(odd):
    return odd.limit(0)
