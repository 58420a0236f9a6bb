"""Events from the daily add/churn staging table and from account-level orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions.predicates import current_rows, folded, same_text, text_in
from martkit.functions.text import STAGING_STATUS, decode_case, mid_token, varchar
from martkit.operators.change import update_from
from martkit.operators.joins import semi_join, spread_join, temporal_join
from martkit.operators.pick import best_rows, latest
from martkit.operators.shape import conform
from martkit.plans.order_events import COMPLETED, END_ACTIONS, KINDS, START_ACTIONS, Keep, asked_kinds, by_kind
from martkit.sources.schemas import EVENT_FACT
from martkit.sources.tables import stage

Tables = Mapping[str, DataFrame]
Span = tuple[date, date]

# Source names, plan groups and segments of the slices.
FBB_STAGING = ("fixed_fbb_adds_stg", "fixed_fbb_canx_stg")
FBB_SOURCE, DATA_SOURCE, BLACKBERRY_SOURCE, ACCOUNT_SOURCE = (
    "adac_fbb", "adac_mobdata", "adac_mob_bb", "oo_awkord",
)
EVENT_GROUPS = ("Gross Adds", "Churns")
SEGMENTS = ("SMB", "Consumer")
ACCOUNT_PLAN_FAMILY = {"rate_plan_lvl_3": "Pacman", "rate_plan_lvl_2": "TBC bolton"}
COUNTED_SOURCES = ("Opom Extract", "adac_fbb", "oo_awkord", "OTT Trans")
MOBILE = "20"


def _staged(t: Tables, window: Span, *sources: str) -> DataFrame:
    return t["all_daily_add_churn"].filter(
        text_in(F.col("src_tbl"), *sources) & F.col("day_dt").between(*map(F.lit, window))
    )


def _fact(df: DataFrame, as_of: date, source: str) -> DataFrame:
    return conform(
        df, EVENT_FACT, only=True, load_date=as_of, src_tbl=source, src_cd="ID", bcc_migrated_ind="N"
    )


def load_fbb(t: Tables, window: Span, as_of: date) -> DataFrame:
    """Fixed broadband speed packs: the plan is found by its description."""
    plans = current_rows(t["cfg_sov_ref"], "end_dt").filter(F.col("rate_plan_cd").isNotNull()).select(
        F.col("rate_plan_cd").alias("bolton_rate_plan_cd"),
        folded(F.col("rate_plan_ds")).alias("_plan"),
    )
    components = current_rows(t["ar_component_definition_values"]).select(
        F.col("component_id").cast("string").alias("basic_rate_plan_cd"),
        F.col("component_id_dv").alias("basic_plan_ds"),
    )
    rows = _staged(t, window, *FBB_STAGING).select(
        decode_case(F.col("svc_stat_cd"), STAGING_STATUS, F.col("svc_stat_cd")).alias("status_cd"),
        "svc_no",
        "acct_no",
        F.col("bill_to_acct_nm").alias("customer_name"),
        F.col("contrct_nm").alias("bolton_rate_plan_ds"),
        folded(F.col("contrct_nm")).alias("_plan"),
        F.col("basic_accs_rate_plan_cd").alias("basic_rate_plan_cd"),
        "cfu",
        F.col("rep_cd").alias("rep_id"),
        F.col("dlr_cd").alias("dealer_cd"),
        F.col("cust_post_cd").alias("post_cd"),
        F.col("ref_no").alias("work_ord_no"),
        F.col("day_dt").alias("bolton_active_dt"),
        F.col("day_dt").alias("work_ord_completion_dt"),
        F.col("rsn_cd").alias("disconnect_reason"),
    )
    joined = rows.join(plans, "_plan").drop("_plan").join(components, "basic_rate_plan_cd", "left")
    return _fact(joined, as_of, FBB_SOURCE)


def _mobile_rows(t: Tables, window: Span, source: str, plans: DataFrame) -> DataFrame:
    groups = t["l_service_event"].filter(text_in(F.col("service_event_grp"), *EVENT_GROUPS)).select(
        F.col("service_event_cd").alias("svc_stat_cd"), F.col("service_event_grp").alias("status_cd")
    )
    named_plans = plans.select(
        F.col("rate_plan_cd").alias("bolton_rate_plan_cd"), F.col("rate_plan_ds").alias("bolton_rate_plan_ds")
    )
    basic = t["cfg_rate_plan_ref"].select(
        F.col("rate_plan_cd").alias("basic_rate_plan_cd"), F.col("rate_plan_ds").alias("basic_plan_ds")
    )
    rows = _staged(t, window, source).filter(text_in(F.col("cfu"), *SEGMENTS)).select(
        "svc_stat_cd",
        "svc_no",
        "acct_no",
        F.col("bill_to_acct_nm").alias("customer_name"),
        "bolton_rate_plan_cd",
        mid_token(F.col("basic_accs_rate_plan_cd")).alias("basic_rate_plan_cd"),
        "cfu",
        F.col("rep_cd").alias("rep_id"),
        F.col("dlr_cd").alias("dealer_cd"),
        F.col("cust_post_cd").alias("post_cd"),
        F.col("day_dt").alias("work_ord_completion_dt"),
        "no_of_svc_x_acct",
    )
    return (
        rows.join(named_plans, "bolton_rate_plan_cd")
        .join(groups, "svc_stat_cd")
        .join(basic, "basic_rate_plan_cd", "left")
        .drop("svc_stat_cd")
    )


def load_mobile_data(t: Tables, window: Span, as_of: date) -> DataFrame:
    """Mobile data add-ons; the day is the active date of adds and the inactive date of churns."""
    plans = t["cfg_rate_plan_ref"].filter(same_text(F.col("prod_grp_lvl_1"), "Mobile Internet Data Bolt On"))
    rows = _mobile_rows(t, window, "mob_mobile_data", plans)
    day = F.col("work_ord_completion_dt")
    dated = rows.withColumn(
        "bolton_active_dt", F.when(same_text(F.col("status_cd"), "Gross Adds"), day)
    ).withColumn("bolton_inactive_dt", F.when(same_text(F.col("status_cd"), "Churns"), day))
    return _fact(dated, as_of, DATA_SOURCE)


def load_blackberry(t: Tables, window: Span, as_of: date) -> DataFrame:
    """Commissionable Blackberry add-ons; the day fills both dates."""
    plans = t["cfg_rate_plan_ref"].filter(
        same_text(F.col("commissionable_in"), "Y")
        & (F.col("bb_cnt_in") == "1")
        & (F.col("bolton_in") == "1")
        & same_text(F.col("prod_grp_lvl_1"), "Blackberry")
    )
    rows = _mobile_rows(t, window, "mob_blackberry", plans)
    day = F.col("work_ord_completion_dt")
    dated = rows.withColumn("bolton_active_dt", day).withColumn("bolton_inactive_dt", day)
    return _fact(dated, as_of, BLACKBERRY_SOURCE)


def account_addons(t: Tables, window: Span, kinds: str | Sequence[str]) -> DataFrame:
    """Completed account-level orders of one plan family, added or cancelled; ``kind`` tells which.

    Both kinds read the tables once.  Components meet their packages first, so that the join with the orders is the last one that
    shuffles and copies collapse where it left them.
    """
    kinds = asked_kinds(kinds)
    family = t["cfg_rate_plan_ref"]
    for column, value in ACCOUNT_PLAN_FAMILY.items():
        family = family.filter(same_text(F.col(column), value))
    family = family.select(
        F.col("rate_plan_cd").alias("component_id"), F.col("prod_grp_lvl_3").alias("plan_type")
    )
    names = current_rows(t["ar_component_definition_values"]).select(
        F.col("component_id").cast("string").alias("component_id"), "component_id_dv"
    )
    orders = (
        t["oo_awkord"]
        .filter(
            (F.col("work_ord_status").cast("string") == COMPLETED)
            & F.col("work_ord_completion_dt").between(*map(F.lit, window))
        )
        .select(
            "work_ord_no", F.col("acct_id").alias("acct_no"), "dealer_cd", "work_ord_create_dt",
            "work_ord_completion_dt", "work_ord_completion_tm", "work_ord_type",
        )
    )
    action = F.col("bill_product_action")
    started = action.isin(*START_ACTIONS) & F.col("active_dt").isNotNull()
    ended = action.isin(*END_ACTIONS) & F.col("inactive_dt").isNotNull()
    wanted = {"add": started, "churn": ended}
    components = (
        t["oo_btxncm"]
        .filter(reduce(Column.__or__, [wanted[k] for k in kinds]))
        .select(
            "int_pack_inst", F.col("component_id").cast("string").alias("component_id"),
            "active_dt", "inactive_dt", "bill_product_action",
        )
        .join(family, "component_id")
    )
    packages = t["oo_btxnpa"].select("work_ord_no", "int_pack_inst", "package_id")
    found = packages.join(components, "int_pack_inst").drop("int_pack_inst")
    found = found.withColumn("kind", F.when(action.isin(*START_ACTIONS), "add").otherwise("churn"))
    return orders.join(found, "work_ord_no").join(names, "component_id", "left").distinct()


def account_addon_fact(t: Tables, addons: DataFrame, as_of: date) -> DataFrame:
    """Account add-ons with the voice plan valid on the active date; the plan ending last wins, for each kind by itself.

    The plan depends on (account, active date) only, so each distinct pair looks it up once.
    """
    plans = t["f_tbc_acct_plans"].filter(same_text(F.col("plan_type"), "Voice Plan")).select(
        "acct_no", "plan_active_dt", "plan_inactive_dt",
        F.col("bill_to_nm").alias("customer_name"),
        varchar(F.col("plan_component_id"), 15).alias("basic_rate_plan_cd"),
        F.col("plan_component_desc").alias("basic_plan_ds"),
        "post_cd",
    )
    pairs = addons.select("acct_no", "active_dt").distinct()
    found = temporal_join(
        pairs, plans, ["acct_no"], "active_dt", "plan_active_dt", "plan_inactive_dt",
        among=addons,
    )
    found = best_rows(found, ["acct_no", "active_dt"], [latest("plan_inactive_dt")]).drop("plan_active_dt")
    joined = spread_join(addons.drop("plan_type"), found, ["acct_no", "active_dt"], "left")
    picked = best_rows(joined, ["acct_no", "component_id", "work_ord_no", "kind"], [latest("plan_inactive_dt")])
    named = picked.withColumn("component_id", varchar(F.col("component_id"), 15)).withColumnsRenamed(
        {
            "component_id": "bolton_rate_plan_cd",
            "component_id_dv": "bolton_rate_plan_ds",
            "active_dt": "bolton_active_dt",
        }
    )
    return conform(
        named, EVENT_FACT, status_cd=by_kind(F.lit("Gross Adds"), F.lit("Churns")), cfu="SMB", load_date=as_of, src_tbl=ACCOUNT_SOURCE,
        src_cd="ID", bcc_migrated_ind="N",
    )


def _uncounted(window: Span) -> Column:
    return F.col("no_of_svc_x_acct").isNull() & F.col("work_ord_completion_dt").between(*map(F.lit, window))


def services_per_account(t: Tables, events: DataFrame, window: Span) -> DataFrame:
    """Distinct mobile services of every account touched in the window.

    Services that end after the window do not count, those without an end or ended before do.  Picking
    one row per service first would not change a distinct count, so it is left out.
    """
    touched = events.filter(_uncounted(window) & text_in(F.col("src_tbl"), *COUNTED_SOURCES))
    end = F.lit(window[1])
    ids = current_rows(t["oo_svciex"]).filter(
        (F.col("ext_id_type") == MOBILE) & (F.col("end_dt").isNull() | (F.col("end_dt") <= end))
    )
    services = current_rows(t["oo_svcins"]).filter(F.col("end_dt").isNull() | (F.col("end_dt") <= end))
    services = semi_join(services.select("acct_id", "svc_inst_id"), touched, "acct_id", "acct_no")
    return (
        semi_join(services, ids, "svc_inst_id", "svc_inst_id")
        .groupBy("acct_id")
        .agg(F.count_distinct("svc_inst_id").cast("int").alias("no_of_svc_x_acct"))
    )


def apply_services_per_account(events: DataFrame, counts: DataFrame, window: Span) -> DataFrame:
    """Write the counts on mobile event rows of the window that have none."""
    return update_from(
        events,
        counts,
        [("acct_no", "acct_id")],
        {"no_of_svc_x_acct": "no_of_svc_x_acct"},
        when=_uncounted(window) & (F.col("ext_id_type") == MOBILE),
    )


def account_addon_events(t: Tables, window: Span, as_of: date, keep: Keep = stage) -> DataFrame:
    """Adds and cancels of account-level add-ons.  Stored once: the plan lookup reads them three times."""
    addons = keep(account_addons(t, window, KINDS), "account_addons")
    return account_addon_fact(t, addons, as_of)
