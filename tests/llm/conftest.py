import pytest

from delayworks.llm.tables import ship


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text, source), with any further columns given by name."""
    ship(spark)

    def build(rows, extra=""):
        return spark.createDataFrame(rows, f"doc_id long, text string, source string{extra}")

    return build
