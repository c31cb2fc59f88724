import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def ready(spark):
    from mdq.session import ship_package
    ship_package(spark)
    return spark


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make_docs(ready):
    """Documents from (doc_id, text[, lang[, source]]) rows; ``extra`` adds
    columns whose names operators use themselves."""
    def build(rows, extra=()):
        from pyspark.sql import functions as F
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = ready.createDataFrame(full, SCHEMA)
        for c in extra:
            df = df.withColumn(c, F.lit("x"))
        return df
    return build


@pytest.fixture
def tables(ready, tmp_path):
    """Write tables as Parquet and return their folder."""
    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
