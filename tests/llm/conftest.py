import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"

ODD_TEXTS = [
    (1, None), (2, ""), (3, "   \t\n"), (4, "One two three."), (4, "One two three."), (None, "no id here at all"),
    (5, "x" * 30_000), (6, "wordy text " * 5_000), (7, "é日本 👍🏽     ñ"), (8, "\u0000\u001c12 +1 @ . - "),
]


@pytest.fixture()
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like results."""
    rows = [(i, t, None if i == 2 else "en", f"s{i}", -1, "mine", [1]) for i, t in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_words int, hits string, tokens array<int>"
    )


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
