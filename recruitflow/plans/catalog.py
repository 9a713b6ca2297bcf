"""All marts at once: as temp views (for SQL / BI users) or written out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recruitflow.params import Params
from recruitflow.plans.candidate_action_log import candidate_action_log
from recruitflow.plans.candidate_basic_info import candidate_basic_info
from recruitflow.plans.company_action_log import company_action_log
from recruitflow.plans.company_action_log_fixed import company_action_log_fixed
from recruitflow.plans.company_info import company_info
from recruitflow.plans.job_info import job_info
from recruitflow.sources.sinks import publish_entity, publish_log, read_published, write_entity, write_log
from recruitflow.sources.tables import Tables

LOGS: dict[str, Callable[[Tables, Params], DataFrame]] = {
    "candidate_action_log": candidate_action_log,
    "company_action_log": company_action_log,
    "company_action_log_fixed": company_action_log_fixed,
}
ENTITIES: dict[str, Callable[[Tables, Params], DataFrame]] = {
    "candidate_basic_info": candidate_basic_info,
    "company_info": company_info,
    "job_info": job_info,
}


def register_views(spark: SparkSession, t: Tables, p: Params, prefix: str = "") -> list[str]:
    """Register every mart as a temporary view (lazy: nothing runs here)."""
    names = []
    for name, fn in {**LOGS, **ENTITIES}.items():
        fn(t, p).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def write_all(t: Tables, p: Params, out_root: str, only: list[str] | None = None, published: bool = False) -> list[str]:
    """Write the marts under ``out_root/<name>``: logs partitioned by month,
    entities as plain Parquet.  Returns the names written.

    ``published`` writes each as a new version and switches to it when it
    is whole (``sinks.publish``; read with ``sinks.read_published``).
    """
    done = []
    for marts, write in ((LOGS, publish_log if published else write_log),
                         (ENTITIES, publish_entity if published else write_entity)):
        for name, fn in marts.items():
            if only is None or name in only:
                write(fn(t, p), f"{out_root.rstrip('/')}/{name}")
                done.append(name)
    return done


def register_published(spark: SparkSession, out_root: str, names: list[str], prefix: str = "") -> None:
    """Register published marts as temporary views of the versions in force now."""
    for name in names:
        read_published(spark, f"{out_root.rstrip('/')}/{name}").createOrReplaceTempView(prefix + name)
