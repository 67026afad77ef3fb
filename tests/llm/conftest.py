import pytest
from pyspark.sql import functions as F

from panelwright.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True, scope="session")
def importable(spark):
    common.importable(spark)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    prose = " ".join(f"word{k} stands here {k * k % 97}" for k in range(120))
    long = "\n".join(" ".join(f"{chr(97 + (k * 7 + j) % 26)}{k}x{j}" for j in range(9)) for k in range(9_000))
    return [
        (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, prose, "en", "a", len(prose)), (3, prose, "en", "a", len(prose)),
        (None, prose, "en", None, None), (4, long, "en", "b", len(long)), (5, "aaaa" * 900, "en", "b", 3600),
        (6, " \n\t \n", "en", "b", 5), (7, "é" * 450 + "日本語 " * 300 + "\x0b👍", "de", None, 1), (8, prose + " more", "en", "a", 1),
        (9, "a b", "en", "a", 3), (9, "a c", "en", "a", 3), (10, "<|endoftext|> don't <|endoftext|>  stop\n", "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows, tmp_path_factory):
    """The rows as a stored table, with extra columns that other names clash with."""
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    extra = {c: F.lit(7) for c in ("_place", "fp", "h", "n", "kept", "length", "sequence_id", "component_id", "piece", "_row", "e", "_key")}
    spark.createDataFrame(edge_rows, SCHEMA).withColumns(extra).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
