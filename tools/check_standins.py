"""Check that Spark and DuckDB derive identical stand-in tables."""
import sys

sys.path.insert(0, ".")
from oracle.standin_sql import STANDIN, with_clause  # noqa: E402
from recruitflow.session import local_session  # noqa: E402
from recruitflow.sources.standins import standin_tables  # noqa: E402
from recruitflow.sources.tables import SOURCE_SCHEMAS  # noqa: E402
from tools.compare import digest, diff_sample, duck, duck_rows, spark_rows  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = local_session(8)
con = duck(sf)
t = standin_tables(spark, sf)
bad = 0
for n in SOURCE_SCHEMAS:
    c1, r1 = spark_rows(t[n])
    c2, r2 = duck_rows(con, with_clause(STANDIN, [n]) + f"\nSELECT * FROM {n}")
    ok = digest(c1, r1) == digest(c2, r2) and sorted(c1) == sorted(c2)
    bad += not ok
    print(f"{n:34s} {'OK ' if ok else 'BAD'} {len(r1)}/{len(r2)}")
    if not ok:
        a, b = diff_sample(c1, r1, c2, r2, 3)
        print("  spark:", a, "\n  duck :", b)
sys.exit(1 if bad else 0)
