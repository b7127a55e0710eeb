import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, line_n int"


@pytest.fixture
def docs(spark):
    """Documents with two extra columns whose names the operators use themselves."""
    def make(rows):
        return spark.createDataFrame(
            [(k, t, "en", "s", None if t is None else len(t), "x", 7) for k, t in rows], SCHEMA)
    return make
