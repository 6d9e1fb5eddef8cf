"""Queries by name, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import population as pop
from ..sources.applications import APPLICATIONS_SQL
from ..sources.shared import prepared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

COMMON_SQL = APPLICATIONS_SQL + """,
base AS (SELECT * FROM applications WHERE fuera_norma = 'n' AND fraud_flag = 'n' AND nature_holder <> 'legal'),
clean AS (
  SELECT authorization_id, mis_date, segment_cut_off, se_decision_id, score_rf, risk_score_rf, early_bad, oa_amt, todu_amt_pile_h6, todu_30ever_h6,
    acct_booked_h0, m_ct_direct_sc_a, m_ct_direct_other,
    1 + (score_rf > 350)::INT + (score_rf > 400)::INT + (score_rf > 450)::INT AS score_rf_bin,
    1 + (risk_score_rf > 20)::INT + (risk_score_rf > 50)::INT + (risk_score_rf > 80)::INT AS risk_score_rf_bin,
    CASE WHEN status_name <> 'booked' THEN oa_amt ELSE oa_amt_h0 END AS oa_amt_h0,
    CASE WHEN m_ct_direct_sc_a = 'y' OR m_ct_direct_other = 'y' THEN 'rejected' ELSE status_name END AS status_name,
    CASE WHEN m_ct_direct_sc_a = 'y' THEN '09-score' WHEN m_ct_direct_other = 'y' THEN '08-other' ELSE reject_reason END AS reject_reason
  FROM base),
demand AS (SELECT * FROM clean WHERE mis_date BETWEEN DATE '1998-07-01' AND DATE '1999-06-01'),
booked AS (SELECT * FROM demand WHERE status_name = 'booked'),
recent_demand AS (SELECT * FROM clean WHERE mis_date BETWEEN DATE '1999-07-01' AND DATE '1999-12-01'),
recent_booked AS (SELECT * FROM recent_demand WHERE status_name = 'booked')"""


def query(name: str, sql: str | None = None, common: str = COMMON_SQL):
    """Register a function (spark, sf_dir) -> DataFrame; ``sql`` may use the common views."""

    def register(f):
        QUERIES[name] = f
        if sql is not None:
            text = sql.strip()
            SQL[name] = f"WITH {common},\n{text[5:].strip()}" if text.upper().startswith("WITH ") else f"WITH {common}\n{text}"
        return f

    return register


def clean(spark, sf_dir) -> DataFrame:
    return pop.clean(prepared(spark, sf_dir))


def demand(spark, sf_dir, period=pop.MAIN) -> DataFrame:
    return pop.split_booked_demand(clean(spark, sf_dir), period)[1]


def booked(spark, sf_dir, period=pop.MAIN) -> DataFrame:
    return pop.split_booked_demand(clean(spark, sf_dir), period)[0]
