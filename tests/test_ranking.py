"""Row numbering and per-group winners equal the window functions."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from recruitflow.operators.ranking import asc_nulls_last, first_per_group, first_row, row_number_in_group

rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 20))),
                min_size=1, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_row_number_in_group_equals_window(spark, data):
    # group 0 is made hot: it repeats every row once more
    data = data + [(0, v) for _, v in data]
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id bigint, g bigint, v bigint")
    order = [F.col("v").desc_nulls_first(), F.col("id").asc()]
    got = {r.id: r.rn for r in row_number_in_group(df.repartition(4), "g", order, "rn").collect()}
    want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
            .collect()}
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_first_per_group_equals_window(spark, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id bigint, g bigint, v bigint")
    got = {(r.g, r.id) for r in first_per_group(df, ["g"], [*asc_nulls_last("v"), F.col("id")], "id").collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last(), F.col("id"))
    want = {(r.g, r.id) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_first_row_equals_window(spark, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id bigint, g bigint, v bigint")
    got = {tuple(r) for r in first_row(df, ["g"], [*asc_nulls_last("v"), F.col("id")]).collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last(), F.col("id"))
    want = {tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn").collect()}
    assert got == want
