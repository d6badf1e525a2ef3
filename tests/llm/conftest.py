import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_spark

    yield get_spark(master="local[4]", shuffle_partitions=4, app="tidemark-tests")


@pytest.fixture()
def docs(spark):
    """A frame of (doc_id, text) with the other columns of ``documents``."""
    def make(rows, extra: str = ""):
        full = [(i, t, None if t is None else "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra.split():
            df = df.selectExpr("*", f"1 AS {name}")
        return df
    return make


def words(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghiklmnorstu") for _ in range(r.randint(2, 9))) for _ in range(n))
