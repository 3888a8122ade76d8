import pytest

from wayflux.llm.common import table


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    """All documents of the small tables as (doc_id, text) in order."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"] or "") for r in rows)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and columns that could clash."""
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "one two three four five six"),
            (5, "one two three four five six"), (5, "one two three four five six"),
            (6, long), (7, long + " end"), (7, "other words stand here under the same id"),
            (8, "{}[]()\\$^ \x00 'it''s'   \U0001f600 İ ß"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    return frame.selectExpr("doc_id", "text", "'src0' as source", "cast(null as string) as lang",
                            "7 as id", "'x' as class", "1 as tokens", "'t' as word", "2 as rank")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
