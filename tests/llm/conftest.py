from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]


HARD = [
    (1, "a b c d e f g h i j k l m n o p", "s1"),
    (2, "x a b c d e f g h i j k l m n o p", "s1"),
    (2, "x a b c d e f g h i j k l m n o p", "s1"),
    (3, None, None),
    (4, "", "s2"),
    (5, " \n\t \n", "s2"),
    (None, "a b c d e f g h i j k l m n o p", None),
    (None, None, "s3"),
    (6, "Line\nline \nLINE\n\nother <|endoftext|> é 漢字", "s3"),
    (7, "w " * 30_000, "s1"),
    (8, "q" * 50_000, "s1"),
    (9, "one two", "s2"),
    (10, "One TWO", "s2"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names used inside."""
    kind = "doc_id long, text string, source string"
    frame = spark.createDataFrame(HARD, kind)
    return frame.selectExpr(
        "doc_id",
        "text",
        "'en' AS lang",
        "source",
        "CAST(length(text) AS long) AS n_chars",
        "1 AS row_key",
        "'x' AS node",
        "2 AS verdict",
        "3 AS n_words",
        "4 AS n_lines",
        "5 AS taken",
        "6 AS size",
        "7 AS h",
        "8 AS doc",
        "9 AS shard",
        "10 AS grp",
        "11 AS rest",
        "12 AS piece",
        "13 AS `drop`",
    )


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)
