from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recruitflow.session import shuffle_partitions_for
from recruitflow.sources.sinks import current_version, publish_entity, publish_log, read_published, write_log


def test_write_log_partitions_by_month(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2018, 1, 3, 5), "a", 1), (datetime(2018, 2, 1), "b", 2),
                                (datetime(2018, 2, 9), "b", 3)], "act_date timestamp_ntz, act_type string, act_id bigint")
    out = str(tmp_path / "log")
    write_log(df, out)
    back = spark.read.parquet(out)
    assert sorted((str(r.act_month), r.act_id) for r in back.collect()) == \
        [("2018-01-01", 1), ("2018-02-01", 2), ("2018-02-01", 3)]
    assert sorted(p.name for p in (tmp_path / "log").iterdir() if p.is_dir()) == \
        ["act_month=2018-01-01", "act_month=2018-02-01"]


def test_shuffle_partitions_for():
    assert shuffle_partitions_for(10) == 200
    assert shuffle_partitions_for(100 * 2**40) == 409600


def test_write_log_leaves_exactly_the_log(spark, tmp_path):
    """The window moves a month and a month becomes empty: the folder holds the new log only."""
    schema = "act_date timestamp_ntz, act_type string, act_id bigint"
    months = lambda *m: spark.createDataFrame([(datetime(2018, k, 3), "a", k) for k in m], schema)
    out = str(tmp_path / "log")
    write_log(months(1, 2, 3), out)
    write_log(months(2, 4), out)
    assert sorted(r.act_id for r in spark.read.parquet(out).collect()) == [2, 4]
    write_log(months(5), out, only_months_present=True)
    assert sorted(r.act_id for r in spark.read.parquet(out).collect()) == [2, 4, 5]


def test_catalog_tables_have_the_declared_types(spark):
    from recruitflow.sources.tables import SOURCE_SCHEMAS, Tables
    spark.sql("CREATE DATABASE IF NOT EXISTS typed")
    for name, schema in SOURCE_SCHEMAS.items():
        empty = spark.createDataFrame([], schema)
        loose = empty.select(*[empty[f.name].cast("string") if f.name.endswith("_date") else empty[f.name]
                               for f in schema.fields])
        loose.write.mode("overwrite").saveAsTable(f"typed.{name}")
    t = Tables.from_catalog(spark, "typed")
    for name, schema in SOURCE_SCHEMAS.items():
        assert [(f.name, f.dataType) for f in t[name].schema] == [(f.name, f.dataType) for f in schema]


def test_a_refresh_that_fails_leaves_the_last_log(spark, tmp_path):
    """A job that dies while it writes, after some files are there: readers still see the version before."""
    schema = "act_date timestamp_ntz, act_type string, act_id bigint"
    months = lambda *m: spark.createDataFrame([(datetime(2018, k, 3), "a", k) for k in m], schema)
    ids = lambda: sorted(r.act_id for r in read_published(spark, out).collect())
    out = str(tmp_path / "log")
    with pytest.raises(FileNotFoundError):
        read_published(spark, out)
    first = publish_log(months(1, 2, 3), out)
    assert ids() == [1, 2, 3] and current_version(spark, out) == first
    bad = months(4, 5).withColumn("act_type", F.when(F.col("act_id") == 5, F.raise_error("broken")).otherwise("a"))
    with pytest.raises(Exception, match="broken"):
        publish_log(bad, out)
    assert ids() == [1, 2, 3] and current_version(spark, out) == first
    reader = read_published(spark, out)  # begun before the switch
    publish_log(months(2, 4), out)
    assert ids() == [2, 4] and sorted(r.act_id for r in reader.collect()) == [1, 2, 3]
    publish_log(months(5), out, only_months_present=True)
    assert ids() == [2, 4, 5]
    changed = months(4).withColumn("act_id", F.lit(40).cast("bigint"))
    publish_log(changed, out, only_months_present=True)
    assert ids() == [2, 5, 40]
    assert len(list((tmp_path / "log" / "_versions").iterdir())) == 2  # the one in force and the one before


def test_published_entity(spark, tmp_path):
    out = str(tmp_path / "entity")
    for n in (3, 5):
        publish_entity(spark.range(n), out)
        assert read_published(spark, out).count() == n
