import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """A documents table of texts; its extra columns carry names that the operators use inside."""

    def run(texts, ids=None, lang=None):
        rows = [((ids[k] if ids else k), t, lang[k] if lang else None, None, None) for k, t in enumerate(texts)]
        df = spark.createDataFrame(rows, SCHEMA)
        for name in ("fp", "component_id", "hits", "mark", "n_words", "key", "y", "score", "n_lines", "refs", "kept"):
            df = df.withColumn(name, F.lit(None).cast("string"))
        return df

    return run
