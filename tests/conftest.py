import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("recruitflow-tests")
         .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def tiny(spark):
    """Factory: Tables with every source empty except the given rows."""
    from recruitflow.sources.tables import SOURCE_SCHEMAS, Tables

    def make(**rows):
        frames = {}
        for name, schema in SOURCE_SCHEMAS.items():
            data = rows.get(name, [])
            frames[name] = spark.createDataFrame([tuple(r) for r in data], schema)
        return Tables(frames)

    return make
