import os

import pytest
from tests_data import PROSE

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Columns that could clash with names the operators use inside.
CLASHING = ["key", "score", "node", "words", "label", "band", "pivot", "size", "host", "tree", "payload", "held_out"]


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with NULLs, empty and very long texts, repeated rows, and columns with clashing names."""
    texts = [
        (1, ""), (2, None), (None, "nobody knows the number of this text about rivers"), (3, "x" * 150_000),
        (4, "word " * 40_000), (5, PROSE), (5, PROSE), (6, PROSE + " again"), (7, " \n\t "), (8, "tiny"), (9, PROSE),
    ]
    rows = [(d, t, "en", None, None if t is None else len(t), *["clash"] * len(CLASHING)) for d, t in texts]
    names = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
