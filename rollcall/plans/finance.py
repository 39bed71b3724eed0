"""Finance: local accounts and actual snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import flag_first_by_key
from .registry import dataset


@dataset("dim_local_account", grain=("k_local_account",), domain="finance")
def dim_local_account(wh) -> DataFrame:
    """P1 projection of local accounts."""
    a = wh("stg_ef3__local_accounts")
    return a.select("k_local_account", "k_school", "tenant_code", "fiscal_year", "local_account_identifier",
                    "local_account_name", "ed_org_id", "ed_org_type")


@dataset("fct_local_actual_snapshots", grain=("k_local_actual_snapshot",), domain="finance")
def fct_local_actual_snapshots(wh) -> DataFrame:
    """Actuals of known accounts (J1) with a latest-snapshot flag.

    Latest = greatest as-of date per account, ties broken by the snapshot key.
    An account can be hot, so the flag is computed with an aggregate (partial
    aggregation, skew-safe) rather than a window over the account.
    """
    s = wh("stg_ef3__local_actuals")
    acct = wh("dim_local_account").select("k_local_account", "k_school")
    j = s.join(acct, "k_local_account")
    neg_days = -F.datediff(F.col("as_of_date"), F.lit("1970-01-01").cast("date"))
    j = flag_first_by_key(j, "is_latest_snapshot", ["k_local_account"], neg_days, "k_local_actual_snapshot")
    return j.select("k_local_actual_snapshot", "k_local_account", "k_school", "tenant_code", "as_of_date",
                    "local_account_identifier", "ed_org_id", "fiscal_year", "amount", "financial_collection",
                    "is_latest_snapshot")


@dataset("fct_local_budget_snapshots", grain=("k_local_budget_snapshot",), domain="finance")
def fct_local_budget_snapshots(wh) -> DataFrame:
    """Budgets of known accounts (J1) with the latest-snapshot flag (W3, skew-safe)."""
    s = wh("stg_ef3__local_budgets")
    j = s.join(wh("dim_local_account").select("k_local_account", "k_school"), "k_local_account")
    neg_days = -F.datediff(F.col("as_of_date"), F.lit("1970-01-01").cast("date"))
    return flag_first_by_key(j, "is_latest_snapshot", ["k_local_account"], neg_days, "k_local_budget_snapshot")


ACCOUNT_DIMENSION_NAMES = ("fund", "function", "object", "program", "project", "source", "operational_unit",
                           "balance_sheet")


@dataset("dim_chart_of_account", grain=("k_chart_of_account",), domain="finance")
def dim_chart_of_account(wh) -> DataFrame:
    """J2 x 8: account with the code and name of each optional dimension
    (dimension tables are small, so the star of left joins broadcasts)."""
    a = wh("stg_ef3__chart_of_accounts")
    for d in ACCOUNT_DIMENSION_NAMES:
        a = a.join(wh(f"stg_ef3__{d}_dimensions"), f"k_{d}_dimension", "left")
    return a
