import pytest


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        """Documents of (id, text, ...) rows; columns that a row leaves out are null."""
        n = len(schema.split(","))
        return spark.createDataFrame([tuple(r) + (None,) * (n - len(r)) for r in rows], schema)

    return make
