import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    def make(*rows, clash=False):
        full = []
        for r in rows:
            d = r if isinstance(r, dict) else {"doc_id": r[0], "text": r[1]}
            full.append((d.get("doc_id"), d.get("text"), d.get("lang", "en"), d.get("source", "s"), len(d.get("text") or "")))
        df = spark.createDataFrame(full, DOC)
        if clash:
            names = ["size", "target", "taken", "u", "sid", "rk1", "RK2", "kept", "gone", "n_lines", "f", "base_failed", "row", "_i", "_k", "_n", "_t", "fp", "items", "used", "y", "score", "held_out", "hits", "words", "n", "a", "b", "value", "b.c", "_", "none", "b`c"]
            df = df.select("*", *[F.lit(7).alias(c) for c in names])
        return df

    return make


@pytest.fixture
def table_dir(tmp_path):
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
