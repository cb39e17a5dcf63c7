import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"


def _texts():
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    base = [None, "", " ", "\n", "word", "\t\n\x0b\x0c\r ", "Ein Süßes Öl über 日本語 \U0001f600 \x00 \x1c \x85 end",
            "same text here twice over and over again", "same text here twice over and over again",
            long, long, long + " tail", "x" * 5000, "# " * 100, "<|endoftext|> in text <|endoftext|>",
            "a b c " * 60, "line one is long enough here\n" * 4, "  LINE one is long enough here \nother\n", "line one is long enough HERE\t"]
    return base


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and extra columns with clashing names."""
    rows = [(i, t, "en", f"s{i % 3}", i) for i, t in enumerate(_texts())]
    rows += [rows[7], rows[9], (None, "a row without an id", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, n_words string, source string, kept long").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pairs():
    """(doc_id, text) rows of a DataFrame, on the driver."""
    return lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def same():
    """Assert equal multisets of rows; columns in the order given."""
    def check(df, columns, expected):
        got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
        want = sorted(map(repr, expected))
        assert len(got) == len(want)
        assert got == want
    return check
