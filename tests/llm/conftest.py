import pytest


@pytest.fixture
def documents(spark):
    """Makes a documents table with clashing extra columns from (doc_id, text) rows."""

    def make(rows, lang="en"):
        schema = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, kept string"
        full = [(i, t, lang, "s", len(t or ""), "other", "x") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def folder(tmp_path):
    """Writes a frame as a table of a new folder and returns the folder."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
