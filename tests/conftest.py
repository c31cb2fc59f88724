import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from datapaths import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("mdq-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mdq-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def schemas(spark):
    from pyspark.sql import types as T

    from mdq.sources.tables import TABLE_NAMES, Tables
    t = Tables.from_tpch(spark, SF_SMALL)
    return {n: T.StructType([T.StructField(f.name, f.dataType, True) for f in t[n].schema.fields])
            for n in TABLE_NAMES}


@pytest.fixture
def make_tables(spark, schemas):
    """Build a Tables registry from literal rows (dicts; missing columns are NULL)."""
    import datetime as dt
    import decimal

    from mdq.sources.tables import TABLE_NAMES, Tables

    def conv(v, f):
        if v is None:
            return None
        tn = f.dataType.typeName()
        if tn == "decimal":
            return decimal.Decimal(str(v))
        if tn == "date" and isinstance(v, str):
            return dt.date.fromisoformat(v)
        return v

    def build(**tables):
        loaders = {}
        for n in TABLE_NAMES:
            sch = schemas[n]
            rows = [tuple(conv(r.get(f.name), f) for f in sch.fields) for r in tables.get(n, [])]
            loaders[n] = (lambda rows=rows, sch=sch: spark.createDataFrame(rows, sch))
        return Tables(spark, loaders)
    return build
