import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import prose  # noqa: E402

#: Names that operators might use for columns of their own.
CLASHES = ("words", "n_words", "score", "part", "shingle", "features", "n", "item_id", "key1", "_row", "kept", "_hits")


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty, blank and long texts, copies, near copies, repeated rows."""
    base = prose(1, 300)
    near = base.split(" ")
    near[150] = "changed"
    rows = [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "one"),
        (8, "one two"),
        (9, "One Two"),
        (10, prose(2, 30_000)),
        (11, "x" * 200_000),
        (12, "### $$$ ||| " * 100),
        (13, prose(3, 80) + "\n" + prose(3, 80)),
        (14, "Released under the MIT License. " + prose(4, 100) + " Apache License"),
        (15, "Été 中文 \x00 \x85   <|endoftext|>  two  spaces 한국"),
        (16, prose(5, 60)),
        (16, prose(5, 60)),
        (None, prose(6, 70)),
    ]
    return rows + [(100 + i, prose(100 + i, 60 + i)) for i in range(30)]


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(*r, "en" if i % 3 else None) for i, r in enumerate(hard_rows)], "doc_id bigint, text string, lang string")
    return docs.withColumns({name: F.lit(i) for i, name in enumerate(CLASHES)})


@pytest.fixture(scope="session")
def no_docs(hard_docs):
    return hard_docs.limit(0)
