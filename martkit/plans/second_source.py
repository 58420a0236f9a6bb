"""Events and month base of the second source system, and overlap flags."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from martkit.functions.predicates import on_days
from martkit.functions.text import ACCOUNT_TYPES, decode_case, whole_number_text
from martkit.operators.change import flag_matched, replace_slice
from martkit.operators.shape import conform
from martkit.sources.schemas import BASE_STAGE, EVENT_FACT, EVENT_STAGE, MONTH_BASE

Tables = Mapping[str, DataFrame]
Span = tuple[date, date]

SECOND = "ED"


def map_second_source_events(t: Tables, window: Span) -> DataFrame:
    """Day transactions of the second source in the event staging layout, the last day whole."""
    day = t["ips_f_subs_bltn_tran_day"].filter(on_days(F.col("curr_ord_actn_done_ts"), *window))
    named = day.select(
        F.col("evnt_type_ds").alias("status_cd"),
        F.col("prim_rsrc_valu_txt").alias("svc_no"),
        whole_number_text(F.col("acct_id")).alias("acct_no"),
        F.col("acct_nm").alias("customer_name"),
        whole_number_text(F.col("bltn_bill_offr_id")).alias("bolton_rate_plan_cd"),
        F.col("bltn_bill_offr_ds").alias("bolton_rate_plan_ds"),
        whole_number_text(F.col("main_bill_offr_id")).alias("basic_rate_plan_cd"),
        F.col("main_bill_offr_ds").alias("basic_plan_ds"),
        decode_case(F.trim("acct_type_cd"), ACCOUNT_TYPES, "Unknown").alias("cfu"),
        F.col("acct_type_cd").alias("owning_cost_ctr"),
        F.col("acct_type_ds").alias("owning_cost_ctr_dv"),
        F.col("appl_cust_type_ds").alias("rental_tariff_group"),
        F.col("curr_agnt_lgin_nm").alias("work_ord_create_id"),
        F.col("curr_deal_id").alias("dealer_cd"),
        F.col("acct_zip_cd").alias("post_cd"),
        F.col("ord_id").alias("work_ord_no"),
        whole_number_text(F.col("subs_id")).alias("svc_inst_id"),
        F.to_date("assg_prce_plan_strt_ts").alias("bolton_active_dt"),
        F.to_date("assg_prce_plan_end_ts").alias("bolton_inactive_dt"),
        F.to_date("curr_ord_actn_done_ts").alias("work_ord_completion_dt"),
        F.to_date("curr_ord_actn_strt_ts").alias("work_ord_create_dt"),
        F.col("curr_ord_actn_type_id").alias("work_ord_type"),
        F.col("curr_ord_actn_type_ds").alias("bill_product_action"),
        F.col("curr_sale_serv_chnl_refr_id").alias("sales_chanl_id"),
        F.col("curr_ord_actn_rsn_ds").alias("disconnect_reason"),
        F.col("curr_ord_actn_rsn_id").alias("disconnect_cd"),
        F.col("prov_deal_id").alias("original_dlr_cd"),
        F.col("prov_agnt_lgin_nm").alias("original_rep_id"),
        F.col("acct_mkt_sgmt_serv_cnt").alias("no_of_svc_x_acct"),
        F.to_date("run_ts").alias("load_date"),
    )
    return conform(named, EVENT_STAGE, only=True, src_cd=SECOND)


def load_second_source_events(
    fact: DataFrame, stage: DataFrame, window: Span, faithful: bool = False
) -> DataFrame:
    """Replace the second source's rows of the window.

    ``faithful=True`` follows the original script instead: it deletes the window of every source and
    appends the whole staging table, which loses first-source rows of the window and repeats
    older second-source rows on every run.
    """
    in_window = F.col("work_ord_completion_dt").between(*map(F.lit, window))
    if faithful:
        return replace_slice(fact, conform(stage, EVENT_FACT, bcc_migrated_ind="N"), in_window)
    rows = conform(stage.filter(in_window), EVENT_FACT, bcc_migrated_ind="N")
    return replace_slice(fact, rows, in_window & (F.col("src_cd") == SECOND))


def flag_migrated_events(fact: DataFrame) -> DataFrame:
    return flag_matched(fact, ["svc_no", "work_ord_completion_dt"])


def map_second_source_base(t: Tables, per_end_dt: date) -> DataFrame:
    """Month base of the second source in the base staging layout, for one reporting month."""
    month = t["ips_f_subs_bltn_base_mnth"]
    # The reporting month end is the one before the source's period end.
    first = per_end_dt + timedelta(days=1)
    month = month.filter((F.col("perd_end_dt") >= F.lit(first)) & (F.col("perd_end_dt") <= F.last_day(F.lit(first))))
    named = month.select(
        F.col("prim_rsrc_valu_txt").alias("svc_no"),
        F.concat(F.trim("prod_type_ds"), F.lit(" "), F.trim("subs_type_ds")).alias("product"),
        F.to_date("orig_actv_ts").alias("svc_start_date"),
        F.date_trunc("second", "assg_prce_plan_strt_ts").alias("product_start"),
        whole_number_text(F.col("bltn_bill_offr_id")).alias("bolton_rate_plan_cd"),
        F.col("bltn_bill_offr_ds").alias("bolton_rate_plan_ds"),
        whole_number_text(F.col("main_bill_offr_id")).alias("basic_rate_plan_cd"),
        F.col("main_bill_offr_ds").alias("basic_plan_ds"),
        whole_number_text(F.col("acct_id")).alias("acct_no"),
        F.col("acct_nm").alias("customer_name"),
        F.col("acct_zip_cd").alias("post_cd"),
        F.col("acct_mkt_sgmt_serv_cnt").alias("no_of_x_svc"),
        F.col("acct_type_cd").alias("owning_cost_ctr"),
        F.col("acct_type_ds").alias("owning_cost_ctr_dv"),
        decode_case(F.trim("acct_type_cd"), ACCOUNT_TYPES, "Unknown").alias("cfu"),
        F.col("prov_deal_id").alias("dlr_cd"),
        F.col("prov_agnt_lgin_nm").alias("rep_id"),
        F.col("prov_sale_serv_chnl_nm").alias("sales_chanl_id"),
    )
    return conform(named, BASE_STAGE, only=True, per_end_dt=per_end_dt, src_cd=SECOND)


def load_second_source_base(
    base: DataFrame, stage: DataFrame, per_end_dt: date, faithful: bool = False
) -> DataFrame:
    """Replace the second source's rows of the month; ``faithful=True`` only appends, as the script does."""
    rows = conform(stage, MONTH_BASE, bcc_migrated_ind="N")
    if faithful:
        return base.unionByName(rows)
    month = F.col("per_end_dt") == F.lit(per_end_dt)
    return replace_slice(base, rows.filter(month), month & (F.col("src_cd") == SECOND))


def flag_migrated_base(base: DataFrame) -> DataFrame:
    return flag_matched(base, ["svc_no", "per_end_dt"])
