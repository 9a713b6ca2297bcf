"""The Spark stand-in derivation equals the DuckDB one, table by table."""
import pytest

from oracle.standin_sql import STANDIN, with_clause
from recruitflow.sources.standins import standin_tables
from recruitflow.sources.tables import SOURCE_SCHEMAS
from tools.compare import digest, duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SOURCE_SCHEMAS))
def test_standin_table_matches(spark, con, name):
    t = standin_tables(spark, SF)
    c1, r1 = spark_rows(t[name])
    c2, r2 = duck_rows(con, with_clause(STANDIN, [name]) + f"\nSELECT * FROM {name}")
    assert c1 == [f.name for f in SOURCE_SCHEMAS[name].fields]
    assert sorted(c1) == sorted(c2) and digest(c1, r1) == digest(c2, r2)
    assert len(r1) > 0
