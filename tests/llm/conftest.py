import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(rows, extra=True):
        """(doc_id, text[, lang[, source]]) rows, with columns that operators use for themselves."""
        full = [(r[0], r[1], *(list(r[2:]) + [None, None])[:2], len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            for name in (
                "score", "lang_pred", "scored", "copies", "size", "text_hash", "kept_id", "start",
                "mix_copies", "pii_found", "v", "key", "copy", "doc_key", "bucket", "a", "chunk", "runs", "h1",
            ):
                frame = frame.withColumn(name, F.lit("x"))
        return frame

    return make
