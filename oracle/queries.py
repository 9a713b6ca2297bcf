"""Oracle SQL per registered query name."""

from __future__ import annotations

from oracle.mart_sql import sql_for

MARTS = {
    "company_info": sql_for("m3"),
    "job_info": sql_for("m6"),
    "candidate_action_log": sql_for("m1"),
    "company_action_log": sql_for("m4"),
    "company_action_log_fixed": sql_for("m5"),
    "candidate_basic_info": sql_for("m2"),
}


def all_sql() -> dict[str, str]:
    from oracle import operator_sql
    return {**MARTS, **operator_sql.SQL}
