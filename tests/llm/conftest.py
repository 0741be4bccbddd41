from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for columns of their own.
CLASHING = (
    "ids decoded n_tokens n_bytes over_limit score predicted held_out label row rules units "
    "matches fp root component_id trie lead first shard document item_id capture picked_id"
).split()
LONG = "of the tionble " * 30_000


def _rows(*texts):
    return [(n, text, "en", "src0", len(text or "")) for n, text in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark):
    """Documents of the given texts, numbered from 0."""
    return lambda *texts: spark.createDataFrame(_rows(*texts), DOCUMENTS)


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, repeated rows, repeated ids."""
    rows = _rows("a plain text.", "", None, LONG, "x" * 50_000, " \n\t ", "a plain text.", "naïve 中文 🙂")
    rows += [rows[0], (None, "no id", None, None, None), (None, None, None, None, None)]
    rows += [(0, "another text under the same id", "en", "src1", 30)]
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    return df.selectExpr("*", *[f"'mine' AS {name}" for name in CLASHING])


@pytest.fixture(scope="session")
def labels(spark):
    schema = "doc_id bigint, quality int, toxic int"
    return lambda *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture(scope="session")
def items(spark):
    return lambda *texts: spark.createDataFrame(
        list(enumerate(texts)), "item_id bigint, text string"
    )
