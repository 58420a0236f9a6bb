"""Billed revenue of the month as commission facts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, functions as F

from martkit.functions.predicates import current_rows, same_text, text_in
from martkit.operators.change import replace_slice
from martkit.operators.joins import spread_join
from martkit.operators.shape import conform
from martkit.sources.schemas import COMMISSION_FACT

Tables = Mapping[str, DataFrame]

# Labels of the fact and of the reporting hierarchy.
RECORD_TYPE = "Bill Revenue"
EQUIPMENT = "Equipment"
REPORT_GROUP = "Business Channels"
REGIONS = ("Business Partners", "Direct")
COUNTERS = (
    "service_count", "bolton_svc_count", "dup_bolton_svc_count", "churn_count", "recontract_count",
    "mob_sov", "mob_connections", "da_connections", "digital_connections", "fixed_sov", "fixed_lines",
    "other_count",
)


def monthly_revenue(t: Tables, per_end_dt: date) -> DataFrame:
    """Net amount per service of the month, equipment charges left out.

    Charge types join on three keys.  A missing ledger code matches a missing one.  A missing product code
    does not, because the two sides default to different texts: on one side it equals the text 'XXX', on
    the other 'XX'.  Lines are summed per charge key before the join, which shrinks them to the distinct
    charges of each service.
    """
    keys = ["sap_gl", "sap_prod_cd", "bill_stmt_chrg_cd"]
    lines = (
        t["f_mob_rev"]
        .filter(
            (F.col("bill_yr_no") == per_end_dt.year) & (F.col("bill_mnth_no") == per_end_dt.month)
        )
        .groupBy("bill_yr_no", "bill_mnth_no", "svc_no", *keys)
        .agg(F.sum("net_amt").alias("net_amt"))
        .select(
            "*",
            F.coalesce("sap_gl", F.lit("XXX")).alias("_gl"),
            F.coalesce("sap_prod_cd", F.lit("XXX")).alias("_prod"),
        )
    )
    charges = t["cfg_rev_ref"].filter(~same_text(F.col("chrg_type_lvl_3"), EQUIPMENT)).select(
        F.coalesce("sap_gl", F.lit("XXX")).alias("_gl"),
        F.coalesce("sap_prod_cd", F.lit("XX")).alias("_prod"),
        "bill_stmt_chrg_cd",
    )
    return (
        lines.join(charges, ["_gl", "_prod", "bill_stmt_chrg_cd"])
        .groupBy("bill_yr_no", "bill_mnth_no", "svc_no")
        .agg(F.sum("net_amt").alias("net_amt"))
    )


def commission_revenue(t: Tables, per_end_dt: date) -> DataFrame:
    """Revenue of services in the mobile base, by plan and by the dealer hierarchy in force."""
    revenue = monthly_revenue(t, per_end_dt).select(F.col("svc_no").alias("service_no"), "net_amt")
    first = per_end_dt.replace(day=1)
    members = t["f_mob_mobilebase"].filter(F.col("per_end_dt").between(F.lit(first), F.lit(per_end_dt)))
    plans = t["zz_cfg_rate_plan_ref"].select(
        "rate_plan_cd",
        F.col("wght_avg_accs_fee").alias("basic_waaf"),
        F.col("prod_grp_lvl_3").alias("basic_product"),
        F.col("rate_plan_ds").alias("basic_plan_ds"),
    )
    dealers = current_rows(t["md_dlr_hier_ref"]).filter(
        same_text(F.col("report_grp_cd"), REPORT_GROUP) & text_in(F.col("regn"), *REGIONS)
    ).select("dlr_cd", "regn", "report_grp_cd", "dlr_hier_ref_eff_dt", "dlr_hier_ref_end_dt")
    joined = (
        members.join(plans, "rate_plan_cd")
        .join(dealers, "dlr_cd")
        .filter(F.col("per_end_dt").between(F.col("dlr_hier_ref_eff_dt"), F.col("dlr_hier_ref_end_dt")))
    )
    named = spread_join(joined, revenue, ["service_no"], "inner").withColumnsRenamed(
        {"per_end_dt": "day_dt", "service_no": "svc_no", "net_amt": "billed_rev"}
    )
    return conform(
        named, COMMISSION_FACT, record_type=RECORD_TYPE, src_tbl="mob_rev", **{c: 0 for c in COUNTERS}
    )


def load_commission_revenue(fact: DataFrame, rows: DataFrame, per_end_dt: date) -> DataFrame:
    """Replace the month's revenue rows."""
    return replace_slice(
        fact, rows, (F.col("record_type") == RECORD_TYPE) & (F.col("day_dt") == F.lit(per_end_dt))
    )
