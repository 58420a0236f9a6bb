"""Television add-on events from activation, disconnection and order transactions."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, functions as F

from martkit.functions.predicates import current_rows, folded, same_text
from martkit.functions.text import decode_case, mid_token, varchar
from martkit.operators.change import update_from
from martkit.operators.joins import asof_join
from martkit.operators.pick import best_rows, latest
from martkit.operators.shape import conform, union_events
from martkit.sources.schemas import EVENT_FACT

Tables = Mapping[str, DataFrame]
Span = tuple[date, date]

# Transaction types and the events they stand for.
TV_EVENTS = {"activation": "Gross Adds", "disconnection": "Churns"}
TV_EVENTS_FOUR = {
    **TV_EVENTS,
    "order": "Orders Submitted",
    "cancellation": "Orders Cancelled",
}
TV_SOURCE = "OTT Trans"


def tv_events(t: Tables, window: Span, labels: Mapping[str, str] = TV_EVENTS) -> DataFrame:
    """Transactions of the window as events, best row per (event, service, plan, day) by dealer and rep."""
    moved = t["ott_at_transaction"].filter(
        F.col("transaction_date").between(*map(F.lit, window))
        & folded(F.col("action_type")).isin(*labels)
    )
    events = moved.select(
        decode_case(F.col("action_type"), labels, None).alias("event"),
        "service_id",
        "account_number",
        F.lit(None).cast("string").alias("customer_name"),
        F.when(same_text(F.col("service_type"), "ONC"), F.col("cmbs_rate_plan_id"))
        .otherwise(F.col("opom_component_id"))
        .alias("bolton_rate_plan_cd"),
        F.col("product_code").alias("bolton_rate_plan_ds"),
        varchar(mid_token(F.col("sys_rate_plan_cd")), 32).alias("basic_rate_plan_cd"),
        F.coalesce("plan_name", "sys_rate_plan_nm").alias("basic_plan_ds"),
        "cfu",
        "dealer_id",
        "rep_id",
        F.col("addr_post_cd").alias("post_cd"),
        "work_ord_no",
        "sos_order_no",
        F.col("transaction_date").alias("bolton_active_dt"),
        F.col("transaction_date").alias("work_ord_completion_dt"),
        F.col("opom_sales_chanl_id").alias("sales_chanl_id"),
    )
    keys = ["event", "service_id", "bolton_rate_plan_cd", "work_ord_completion_dt"]
    # Dealer and rep say little about automated transactions: all rows of a busy service can tie.
    return best_rows(events, keys, [latest("dealer_id"), latest("rep_id")], spread_ties=True)


def _orders(t: Tables) -> DataFrame:
    return t["ott_at_transaction"].filter(same_text(F.col("action_type"), "order")).select(
        "service_id",
        F.col("transaction_date").alias("order_day"),
        F.col("dealer_id").alias("new_dealer_id"),
        F.col("rep_id").alias("new_rep_id"),
    )


def attach_order_dealer(t: Tables, events: DataFrame) -> DataFrame:
    """Dealer and rep of the nearest order day on or before the event; all orders of that day are kept."""
    orders = _orders(t).filter(F.col("new_dealer_id") != "0")
    joined = asof_join(events, orders, ["service_id"], "work_ord_completion_dt", "order_day")
    return joined.withColumn("days_diff", F.datediff("work_ord_completion_dt", "order_day")).drop("order_day")


def attach_customer_name(t: Tables, events: DataFrame) -> DataFrame:
    """Customer name from the newest account that carries the name."""
    open_accounts = current_rows(t["acct"]).select("acct_no", "acct_name", "open_dt")
    newest = best_rows(open_accounts, ["acct_name"], [latest("acct_no"), latest("open_dt")])
    return update_from(events, newest, [("account_number", "acct_no")], {"customer_name": "acct_name"})


def tv_fact(events: DataFrame, as_of: date) -> DataFrame:
    """Fact rows: order dealer and rep are the current ones of adds and the original ones of churns."""
    add, churn = F.col("event") == "Gross Adds", F.col("event") == "Churns"
    named = events.select(
        F.col("event").alias("status_cd"),
        F.col("service_id").alias("svc_no"),
        F.col("account_number").alias("acct_no"),
        "customer_name", "bolton_rate_plan_cd", "bolton_rate_plan_ds", "basic_rate_plan_cd",
        "basic_plan_ds", "cfu",
        F.when(add, F.col("new_dealer_id")).alias("dealer_cd"),
        F.when(add, F.col("new_rep_id")).alias("rep_id"),
        "post_cd", "work_ord_no",
        F.col("sos_order_no").alias("ext_ord_ref_no"),
        "bolton_active_dt", "work_ord_completion_dt",
        F.when(churn, F.col("new_dealer_id")).alias("original_dlr_cd"),
        F.when(churn, F.col("new_rep_id")).alias("original_rep_id"),
    )
    return conform(
        named, EVENT_FACT, only=True, load_date=as_of, src_tbl=TV_SOURCE, src_cd="ID", bcc_migrated_ind="N"
    )


def tv_events_four_way(t: Tables, window: Span, as_of: date) -> DataFrame:
    """Older variant: submitted and cancelled orders are events too, and the first order counts.

    Events keep their own dealer and rep; the earliest prior order day gives the original ones.
    """
    events = attach_customer_name(t, tv_events(t, window, TV_EVENTS_FOUR))
    # Orders of one day: the ones with the highest dealer and rep.
    orders = best_rows(
        _orders(t), ["service_id", "order_day"], [latest("new_dealer_id"), latest("new_rep_id")],
        spread_ties=True,
    )
    submitted = F.col("event") == "Orders Submitted"
    followed = asof_join(
        events.filter(~submitted), orders, ["service_id"], "work_ord_completion_dt", "order_day", "earliest"
    ).drop("order_day")
    alone = events.filter(submitted).select(
        "*",
        F.lit(None).cast("string").alias("new_dealer_id"),
        F.lit(None).cast("string").alias("new_rep_id"),
    )
    named = union_events(followed, alone).withColumnsRenamed(
        {
            "event": "status_cd",
            "service_id": "svc_no",
            "account_number": "acct_no",
            "dealer_id": "dealer_cd",
            "sos_order_no": "ext_ord_ref_no",
            "new_dealer_id": "original_dlr_cd",
            "new_rep_id": "original_rep_id",
        }
    )
    return conform(
        named, EVENT_FACT, load_date=as_of, src_tbl=TV_SOURCE, src_cd="ID", bcc_migrated_ind="N"
    )
