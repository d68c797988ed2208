from __future__ import annotations

from pathlib import Path

import pandas as pd
import pytest

SF = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def sf():
    return str(SF)


@pytest.fixture(scope="session")
def given():
    """A given table as pandas."""
    return lambda name: pd.read_parquet(SF / f"{name}.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns that could clash."""
    same = "one two three four five six seven eight nine ten"
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n", None),
        (4, same, "a"),
        (5, same.upper(), "b"),
        (5, same.upper(), "b"),
        (6, "word", "b"),
        (7, "word", None),
        (None, same, "a"),
        (None, None, None),
        (8, "x" * 5000 + " " + "y " * 60_000, "c"),
        (9, "é’s <|endoftext|> ΑΣ ½ don't", "c"),
    ]
    schema = "doc_id long, text string, source string"
    extra = "*", "'en' AS lang", "1 AS n", "2 AS component", "3 AS key", "4 AS block", "5 AS score"
    return spark.createDataFrame(rows, schema).selectExpr(*extra)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
