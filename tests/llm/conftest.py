import pytest

from parcelhouse.llm.common import prepared


@pytest.fixture(scope="session")
def text_spark(spark):
    return prepared(spark)


@pytest.fixture(scope="session")
def documents(text_spark):
    """documents(rows): doc_id and text, with further columns whose names clash."""
    def make(rows, schema="doc_id long, text string"):
        df = text_spark.createDataFrame(rows, schema)
        for name in ("id", "key", "fp", "tile", "n", "kept", "number", "_id", "label"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df
    return make
