"""Target schemas.  Fixed values: column names, order and types of the loaded facts."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(28,2)": T.DecimalType(28, 2),
}


def _schema(columns: str) -> T.StructType:
    pairs = [c.split() for c in " ".join(columns.split()).replace("28,2", "28;2").split(",")]
    return T.StructType([T.StructField(n, _TYPES[t.replace(";", ",")]) for n, t in pairs])


EVENT_FACT = _schema(
    """
    status_cd string, svc_no string, acct_no string, customer_name string,
    bolton_rate_plan_cd string, bolton_rate_plan_ds string, basic_rate_plan_cd string,
    basic_plan_ds string, ext_id_type string, svc_type string, cfu string, vip_code string,
    owning_cost_ctr string, owning_cost_ctr_dv string, rental_tariff_group string,
    work_ord_create_id string, rep_id string, dealer_cd string, post_cd string,
    work_ord_no string, ext_ord_ref_no string, svc_inst_id string, subscr_no int,
    bolton_active_dt date, bolton_inactive_dt date, work_ord_completion_dt date,
    work_ord_completion_tm string, work_ord_create_dt date, work_ord_create_dt_tm string,
    work_ord_type string, bill_product_action string, svc_action_type string,
    sales_chanl_id string, wrkjn_rep_id string, retl_store string, disconnect_reason string,
    disconnect_cd string, original_dlr_cd string, original_rep_id string,
    no_of_svc_x_acct int, load_date date, src_tbl string, src_cd string,
    bcc_migrated_ind string
    """
)

MONTH_BASE = _schema(
    """
    per_end_dt date, svc_no string, product string, external_id_type smallint,
    svc_start_date date, product_start timestamp_ntz, bolton_rate_plan_cd string,
    bolton_rate_plan_ds string, basic_rate_plan_cd string, basic_plan_ds string, acct_no string,
    customer_name string, post_cd string, no_of_x_svc int, vip_code smallint,
    owning_cost_ctr string, owning_cost_ctr_dv string, cfu string, dlr_cd string, rep_id string,
    sales_chanl_id string, retl_store string, acq_partnr_cmpny string, svc_inst_id string,
    work_ord_no string, ar_subscr_no int, ar_account_no int, src_cd string,
    bcc_migrated_ind string
    """
)

COMMISSION_FACT = _schema(
    """
    record_type string, day_dt date, dlr_cd string, acct_no string, svc_no string,
    accs_meth_id string, rate_plan_cd string, bolton_rate_plan_cd string, basic_waaf double,
    basic_product string, basic_plan_ds string, bolton_waaf int, bolton_product string,
    bolton_plan_ds string, svc_stat_cd string, bill_to_nm string, cfu string,
    contract_term string, contrct_end_dt date, contrct_eff_dt date, work_ord_no string,
    regn string, report_grp_cd string, service_count int, bolton_svc_count int,
    dup_bolton_svc_count int, churn_count int, recontract_count int, mob_sov int,
    mob_connections int, da_connections int, digital_connections int, fixed_sov int,
    fixed_lines int, other_count int, billed_rev decimal(28,2), src_tbl string
    """
)

# The second-source staging copies end before the migration flag.
EVENT_STAGE = T.StructType(EVENT_FACT.fields[:-1])
BASE_STAGE = T.StructType(MONTH_BASE.fields[:-1])
