from __future__ import annotations

import pytest

TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark, tmp_path):
    """Writes (doc_id, text[, lang, source]) rows as a table folder and returns its name."""
    def write(rows, columns=TEXTS, name="documents"):
        full = [(*row, *[None] * (len(columns.split(",")) - len(row))) for row in rows]
        spark.createDataFrame(full, columns).repartition(3).write.mode("overwrite").parquet(
            f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
