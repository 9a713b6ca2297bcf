from recruitflow.__main__ import main
from recruitflow.plans.catalog import register_published, register_views
from recruitflow.plans.standin_queries import STANDIN_PARAMS as P
from recruitflow.sources.standins import write_standins


def test_views_and_job(spark, tmp_path):
    t = write_standins(spark, "/root/testdata/sf0.001", str(tmp_path / "src"))
    names = register_views(spark, t, P)
    assert len(names) == 6
    n = spark.sql("SELECT act_type, count(DISTINCT act_id) AS n FROM company_action_log GROUP BY act_type").count()
    assert n > 5
    done = main(["--sources", str(tmp_path / "src"), "--out", str(tmp_path / "marts"),
                 "--as-of", "2001-07-31T20:00:00", "--since", "2000-08-01",
                 "--input-gb", "0.01", "--only", "company_info,candidate_action_log"], spark=spark.newSession())
    assert sorted(done) == ["candidate_action_log", "company_info"]
    log = spark.read.parquet(str(tmp_path / "marts" / "candidate_action_log"))
    assert "act_month" in log.columns and log.count() > 0
    assert spark.read.parquet(str(tmp_path / "marts" / "company_info")).count() > 0
    with_switch = ["--sources", str(tmp_path / "src"), "--out", str(tmp_path / "published"), "--publish",
                   "--as-of", "2001-07-31T20:00:00", "--since", "2000-08-01", "--only", "company_info"]
    for _ in range(2):  # a refresh
        assert main(with_switch, spark=spark.newSession()) == ["company_info"]
    register_published(spark, str(tmp_path / "published"), ["company_info"], "published_")
    assert spark.table("published_company_info").count() == spark.table("company_info").count()
