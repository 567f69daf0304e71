import pytest
from pyspark.sql import functions as F

#: Rows that every operator on documents must bear: null, empty, blank, long, repeated, without letters.
EDGES = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n ", None),
    (4, "word " * 30_000, "en"),
    (5, "the same line of text for all", "en"),
    (5, "the same line of text for all", "en"),
    (6, "the same line of text for all", "en"),
    (7, "123 456 !!", "de"),
    (None, "a row without an id", None),
    (8, "漢字 é🎉 <|endoftext|> ñ", "es"),
]


#: Columns with the names of helper columns, which must come through.
OWN = {name: f"mine: {name}" for name in "told above found kept_id kept_hash kept_copies place print root _print _n _known _found _above _lang _score _rejected lang_of verdict_of".split()}


def own_columns(df):
    """Whether the columns of ``OWN`` have come through."""
    return df.select(*OWN).distinct().collect() in ([], [tuple(OWN.values())])


@pytest.fixture(scope="session")
def edges(spark):
    """Documents with the edge cases and columns whose names operators use."""
    rows = [(*r, "src", 0.5, "x", 9, *OWN.values()) for r in EDGES]
    own = ", ".join(f"{name} string" for name in OWN)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, score double, predicted string, piece int, {own}")


@pytest.fixture(scope="session")
def empty(edges):
    return edges.where(F.lit(False))


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
