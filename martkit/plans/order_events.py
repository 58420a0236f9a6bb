"""Add-on adds and churns assembled from order, service and account history."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions.dates import HIGH_DATE, or_high
from martkit.functions.predicates import current_rows, in_interval, valid_at
from martkit.functions.text import PRODUCT_ACTIONS, decode_case, varchar
from martkit.operators.hot import key_map, listed, perhaps_touched, touched_by
from martkit.operators.joins import alive_in, decode, segment_of, semi_join, spread_join, temporal_join
from martkit.operators.pick import best_rows, earliest, latest
from martkit.operators.shape import conform, union_events
from martkit.sources.schemas import EVENT_FACT
from martkit.sources.tables import stage

Tables = Mapping[str, DataFrame]
Span = tuple[date, date]
Keep = Callable[[DataFrame, str], DataFrame]

# Codes of the source systems.
COMPLETED = "4"
START_ACTIONS = ("1", "2")
END_ACTIONS = ("3", "4")
EXCLUDED_ACTION_TYPES = ("40", "1")
LIVE_SERVICE = ("1", "3")
SERVICE_ID_TYPES = ("20", "601", "15")
BASIC_PLAN_GROUPS = (3, 4, 5, 6, 22, 24, 25, 26, 27)
VOID_RECORD = "40"
ORDER_SOURCE = "Opom Extract"
# The two kinds of events.
KINDS = ("add", "churn")

ORDER_COLUMNS = [
    "work_ord_no", "ext_ord_ref_no", "svc_inst_id", "work_ord_completion_dt", "work_ord_completion_tm",
    "work_ord_create_dt", "work_ord_create_tm", "work_ord_status", "work_ord_type",
    "work_ord_create_id", "svc_action_type", "dealer_cd",
]
HISTORY_COLUMNS = [
    "svc_no", "acct_id", "start_dt", *ORDER_COLUMNS, "rep_id", "svc_type", "ext_id_type",
    "rental_tariff_grp", "svc_inst_status", "sales_chanl_id", "wrkjn_rep_id", "retl_store",
]


def _service_ids(t: Tables) -> DataFrame:
    return t["oo_svciex"].filter(F.col("ext_id_type").isin(*SERVICE_ID_TYPES)).select(
        "svc_inst_id",
        F.col("ext_id").alias("svc_no"),
        "ext_id_type",
        F.col("start_dt").alias("id_start"),
        F.col("end_dt").alias("id_end"),
        F.col("open_dt").alias("id_open"),
        F.col("close_dt").alias("id_close"),
    )


def _order_reps(t: Tables) -> DataFrame:
    return t["oo_wrkojn"].select(
        "work_ord_no",
        F.col("reps_id").alias("wrkjn_rep_id"),
        "sales_chanl_id",
        "retl_store",
        F.col("open_dt").alias("oj_open"),
        F.col("close_dt").alias("oj_close"),
    )


def order_components(
    t: Tables, order_keys: DataFrame, actions: tuple[str, ...], require: str
) -> DataFrame:
    """Components with the given actions of the given orders; the order keys cut the packages where they are read.

    The cut is rough: a join on the order must follow.
    """
    packages = touched_by(t["oo_btxnpa"].select("work_ord_no", "int_pack_inst"), order_keys, [("work_ord_no", "work_ord_no")])
    components = t["oo_btxncm"].filter(F.col("bill_product_action").isin(*actions) & F.col(require).isNotNull())
    return packages.join(_named_components(components), "int_pack_inst").drop("int_pack_inst")


def _named_components(components: DataFrame) -> DataFrame:
    return components.select(
        "int_pack_inst",
        F.col("component_id").cast("string").alias("component_id"),
        "bill_product_action",
        F.col("active_dt").alias("cmp_active_dt"),
        F.col("inactive_dt").alias("cmp_inactive_dt"),
    )


def asked_kinds(kinds: str | Sequence[str]) -> tuple[str, ...]:
    """One kind of event or both, in one order."""
    asked = (kinds,) if isinstance(kinds, str) else tuple(kinds)
    return tuple(k for k in KINDS if k in asked)


def by_kind(add: Column, churn: Column) -> Column:
    return F.when(F.col("kind") == "add", add).otherwise(churn)


def completed_orders(t: Tables, window: Span, kinds: Sequence[str]) -> DataFrame:
    """Completed orders of the window, one row for each kind of event that an order can be."""
    starts = F.col("work_ord_type").isin(*START_ACTIONS)
    orders = t["oo_wrkord"].filter(
        F.col("work_ord_completion_dt").between(*map(F.lit, window))
        & (F.col("work_ord_status").cast("string") == COMPLETED)
        & ~F.col("svc_action_type").isin(*EXCLUDED_ACTION_TYPES)
    )
    if kinds == ("add",):
        orders = orders.filter(starts)
    others = F.array(*[F.lit(k) for k in kinds if k != "add"]).cast("array<string>")
    kind = F.explode(F.when(starts, F.array(*map(F.lit, kinds))).otherwise(others))
    return orders.select(*ORDER_COLUMNS, "work_ord_close_dt", "disconnect_cd", kind.alias("kind"))


def addon_orders(t: Tables, window: Span, kinds: str | Sequence[str], keep: Keep = stage) -> DataFrame:
    """Completed orders in the window with their add-on components, best history row per order and kind of event.

    Both kinds go through the histories together: what differs between them (grace, the day at which the service counts, which row
    is best) depends on the column ``kind``.  The orders are stored first; their keys, as maps, cut each history where it
    is read.  The order history decides the pick and the components only fan it out, so the pick runs before the component join:
    over orders times overlapping history rows, not times components as well.  Churns also keep the earliest end date per
    (order, component), again within one order.
    """
    kinds = asked_kinds(kinds)
    orders = keep(completed_orders(t, window, kinds), "orders")
    of_service, of_order = key_map(orders, ["svc_inst_id"]), key_map(orders, ["work_ord_no"])
    at, add = "work_ord_completion_dt", F.col("kind") == "add"
    live = F.col("svc_inst_status").isin(*LIVE_SERVICE)
    services = t["oo_svcins"].select(
        "svc_inst_id", "acct_id", "svc_type", "svc_inst_status", "rental_tariff_grp", "start_dt",
        F.col("open_dt").alias("svc_open"), F.col("close_dt").alias("svc_close"),
    )
    if kinds == ("add",):
        services = alive_in(services.filter(live), window, "svc_open", "svc_close", 2)
    # Churn orders meet the service on their close date, which the window does not bound.
    dated = orders.withColumn("_service_at", by_kind(F.col(at), F.col("work_ord_close_dt")))
    history = temporal_join(
        dated, services, ["svc_inst_id"], "_service_at", "svc_open", "svc_close", 2, marks=of_service, extra=~add | live
    )
    history = temporal_join(
        history, alive_in(_service_ids(t), window, "id_open", "id_close", 2), ["svc_inst_id"], at, "id_open", "id_close", 2,
        marks=of_service,
        extra=in_interval(F.col(at), F.col("id_start"), F.col("id_end")),
    )
    reps = t["oo_svcijn"].select(
        "svc_inst_id", "rep_id", F.col("open_dt").alias("rep_open"), F.col("close_dt").alias("rep_close")
    )
    history = temporal_join(
        history, alive_in(reps, window, "rep_open", "rep_close", 2), ["svc_inst_id"], at, "rep_open", "rep_close", 2,
        marks=of_service, extra=add | (F.col("rep_open") <= F.date_add(at, 1)),
    )
    history = temporal_join(
        history, alive_in(_order_reps(t), window, "oj_open", "oj_close", 2), ["work_ord_no"], at, "oj_open", "oj_close", 2,
        "left", marks=of_order,
    )
    # The last key runs the other way for churns, so days count as numbers: a missing first day comes first, a missing last day last.
    last = by_kind(F.coalesce(-F.unix_date("oj_open"), F.lit((1 << 31) - 1)), F.unix_date("oj_close"))
    pick = [
        latest("work_ord_completion_dt"), latest("work_ord_completion_tm"), latest("svc_close"),
        latest(by_kind(F.col("id_open"), F.col("id_close"))),
        latest(by_kind(F.col("id_start"), or_high(F.col("id_end")))),
        latest(F.when(~add, F.col("id_start"))),
        earliest(by_kind(F.col("rep_open"), F.col("rep_close"))),
        latest(last),
    ]
    columns = [*HISTORY_COLUMNS, "disconnect_cd", "kind"]
    # Copies collapse before the pick, so that they cannot pile up as ties of one order.
    ordering = ["svc_close", "id_open", "id_close", "id_end", "id_start", "rep_open", "rep_close", "oj_open", "oj_close"]
    history = history.withColumn("disconnect_cd", F.when(~add, F.col("disconnect_cd"))).select(*columns, *ordering).distinct()
    picked = best_rows(history, ["work_ord_no", "kind"], pick).select(*columns).distinct()

    events = spread_join(_plan_components(t, of_order, kinds), picked, ["work_ord_no", "kind"], "inner")
    if "churn" in kinds:
        return decode(events, t["oo_reftmc"], "disconnect_cd", "disconnect_cd", "disconnect_reason")
    return events.drop("disconnect_cd")


def _plan_components(t: Tables, of_order: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Add-on components of the marked orders; a component's action says to which kind of event it belongs."""
    action = F.col("bill_product_action")
    started = action.isin(*START_ACTIONS) & F.col("active_dt").isNotNull()
    ended = action.isin(*END_ACTIONS) & F.col("inactive_dt").isNotNull()
    wanted = {"add": started, "churn": ended}
    components = _named_components(t["oo_btxncm"].filter(reduce(Column.__or__, [wanted[k] for k in kinds])))
    plans = t["bolton_rp_ref"].filter(F.col("bolton_in") == "1").select(
        F.col("rate_plan_cd").cast("string").alias("component_id"), "rate_plan_ds"
    )
    packages = perhaps_touched(t["oo_btxnpa"].select("work_ord_no", "int_pack_inst"), of_order, ["work_ord_no"])
    found = packages.join(components.join(listed(plans), "component_id"), "int_pack_inst").drop("int_pack_inst")
    found = found.withColumn("kind", F.when(action.isin(*START_ACTIONS), "add").otherwise("churn"))
    if "churn" in kinds:
        # All rows of an add tie and stay.
        ends_first = earliest(F.when(F.col("kind") == "churn", F.col("cmp_inactive_dt")))
        found = best_rows(found, ["work_ord_no", "component_id", "kind"], [ends_first])
    return found.select(
        "work_ord_no", "component_id", "rate_plan_ds", "cmp_active_dt", "cmp_inactive_dt", "kind",
        decode_case(action, PRODUCT_ACTIONS, "NA").alias("cmp_bill_product_act_def"),
    ).distinct()


def attach_account(t: Tables, events: DataFrame, window: Span) -> DataFrame:
    """Account name, VIP code, cost centre and postcode valid at completion (15 days of grace).

    The lookup depends on the account and the completion date only (an order has one completion date),
    so it runs once per distinct pair: an account with very many orders is looked up once per day.
    """
    at = "work_ord_completion_dt"
    pairs = events.select("acct_id", at).distinct()
    ids = current_rows(t["ar_a200"]).filter(F.col("external_id_type").cast("string") == "1").select(
        F.col("external_id").alias("acct_id"), "account_no"
    )
    accounts = t["ar_a100"].select(
        "account_no", "bill_lname", F.col("vip_code").cast("string").alias("vip_code"),
        "owning_cost_ctr", "owning_cost_ctr_dv", "bill_zip", "open_dt", "close_dt",
    )
    known = pairs.join(ids, "acct_id")
    accounts = alive_in(accounts, window, grace=15)
    found = temporal_join(known, accounts, ["account_no"], at, grace=15, among=known)
    picked = best_rows(found.drop("account_no", "open_dt").distinct(), ["acct_id", at], [latest("close_dt")])
    return spread_join(events, picked.drop("close_dt").distinct(), ["acct_id", at], "left")


def derive_segment(t: Tables, events: DataFrame) -> DataFrame:
    """Customer segment by VIP code; action type and tariff group as text."""
    out = segment_of(events, t["md_sales_class_ref"])
    out = decode(out, t["oo_reftmc"], "svc_action_ty", "svc_action_type", "_action")
    out = decode(out, t["oo_reftmc"], "rental_tariff_grp", "rental_tariff_grp", "rental_tariff_group")
    return out.withColumn("svc_action_type", F.col("_action")).drop("_action", "rental_tariff_grp")


def lookup_subscriber(t: Tables, events: DataFrame, window: Span) -> DataFrame:
    """Subscriber number by service and id type at completion, best row per (service, day, order) and kind of event.

    For adds the id may start two days later; for churns it may have ended three days ago, and its record counts as well.
    """
    at, add = "work_ord_completion_dt", F.col("kind") == "add"
    asked = events.select("svc_no", "ext_id_type", "work_ord_no", at, "kind").distinct()
    first, last = (F.lit(d + timedelta(days=n)) for d, n in ((window[0], -3), (window[1], 3)))
    # Bare moments against literals besides, so that the scan can skip row groups.
    ids = t["ar_s200"].filter(
        (F.col("record_type").cast("string") != VOID_RECORD)
        & (F.col("active_date") < last)
        & (F.col("inactive_date").isNull() | (F.col("inactive_date") >= first))
    ).select(
        F.col("external_id").alias("svc_no"),
        F.col("external_id_type").cast("string").alias("ext_id_type"),
        "subscr_no",
        "active_date",
        "inactive_date",
        "open_dt",
        "close_dt",
        F.col("active_date").cast("date").alias("active_day"),
        or_high(F.col("inactive_date").cast("date")).alias("inactive_day"),
    )
    ids = ids.withColumn("late_day", F.date_add("inactive_day", 3))
    of_add = F.col(at) <= F.col("inactive_day")
    of_churn = (F.col(at) >= F.col("active_day")) & valid_at(F.col(at), F.col("open_dt"), F.col("close_dt"), 3)
    found = temporal_join(
        asked, ids, ["svc_no", "ext_id_type"], at, "active_day", "late_day", 2, among=events, extra=by_kind(of_add, of_churn)
    )
    order = [latest("close_dt"), latest(by_kind(F.col("active_date"), F.col("inactive_date")))]
    found = found.select(
        "svc_no", "work_ord_no", "subscr_no", at, "kind", "close_dt", "active_date", "inactive_date"
    ).distinct()
    picked = best_rows(found, ["svc_no", at, "work_ord_no", "kind"], order)
    return picked.select("svc_no", "work_ord_no", "subscr_no", at, "kind").distinct()


def basic_components(t: Tables) -> DataFrame:
    return current_rows(t["ar_component_definition_values"]).select(
        F.col("component_id").cast("string").alias("basic_rate_plan_cd"), "component_id_dv", "short_display"
    )


def basic_packages(t: Tables) -> DataFrame:
    return current_rows(t["ar_package_definition_ref"]).filter(
        F.col("package_group").isin(*BASIC_PLAN_GROUPS)
    ).select("package_id", "package_group")


def lookup_basic_plan(t: Tables, subscribers: DataFrame, window: Span) -> DataFrame:
    """Basic plan of the subscriber at completion, best row per (service, day, order) and kind; for adds open records alone."""
    at = "work_ord_completion_dt"
    held = t["ar_p200"].filter(
        (F.col("product_start") < F.lit(window[1] + timedelta(days=1)))
        & (F.col("product_stop").isNull() | (F.col("product_stop") >= F.lit(window[0])))
    ).select(
        "subscr_no",
        "component_id",
        "package_id",
        "product_start",
        "product_stop",
        F.col("close_dt").alias("plan_close"),
        F.col("product_start").cast("date").alias("start_day"),
        or_high(F.col("product_stop").cast("date")).alias("stop_day"),
    )
    held = touched_by(held, subscribers, [("subscr_no", "subscr_no")])
    # Codes cut the rows where they are read; names come after the pick, which does not depend on them.
    held = held.join(listed(basic_packages(t).select("package_id").distinct()), "package_id", "left_semi").drop("package_id")
    names, code = basic_components(t).distinct(), F.col("component_id").cast("string")
    codes = names.select(F.col("basic_rate_plan_cd").alias("_code")).distinct()
    held = held.join(listed(codes), code == F.col("_code"), "left_semi")
    found = temporal_join(
        subscribers, held, ["subscr_no"], at, "start_day", "stop_day",
        extra=(F.col("kind") != "add") | (F.col("plan_close") == F.lit(HIGH_DATE)),
    )
    # Open records share their last day, so it changes nothing for adds.
    order = [latest("product_start"), latest("product_stop", HIGH_DATE), latest("plan_close")]
    columns = ["svc_no", "work_ord_no", "subscr_no", "component_id", at, "kind"]
    # The pick cuts every group where its subscriber is joined, before the one shuffle; copies collapse after it.
    found = found.select(*columns, "product_start", "product_stop", "plan_close")
    picked = best_rows(found, ["svc_no", at, "work_ord_no", "kind"], order).select(*columns).distinct()
    return picked.withColumn("basic_rate_plan_cd", code).join(listed(names), "basic_rate_plan_cd").drop("component_id")


def consolidate(events: DataFrame, basic: DataFrame) -> DataFrame:
    """Events with the basic plan of the same service and order, named as in the fact."""
    plan = basic.select(
        "svc_no", "work_ord_no", "kind", "subscr_no",
        varchar(F.trim("basic_rate_plan_cd"), 15).alias("basic_rate_plan_cd"),
        F.col("component_id_dv").alias("basic_plan_ds"),
    )
    named = events.withColumnsRenamed(
        {
            "acct_id": "acct_no",
            "bill_lname": "customer_name",
            "component_id": "bolton_rate_plan_cd",
            "rate_plan_ds": "bolton_rate_plan_ds",
            "bill_zip": "post_cd",
            "cmp_active_dt": "bolton_active_dt",
            "cmp_inactive_dt": "bolton_inactive_dt",
            "cmp_bill_product_act_def": "bill_product_action",
            "work_ord_create_tm": "work_ord_create_dt_tm",
        }
    ).drop("start_dt", "work_ord_status", "svc_inst_status")
    return spread_join(named, plan, ["svc_no", "work_ord_no", "kind"], "left")


def original_order(t: Tables, churns: DataFrame, keep: Keep = stage) -> DataFrame:
    """Latest completed add order for each churned (service, component, active date).

    Dates pick the order before the order history is joined: only winners meet the history.  Dealer and
    representative are all that is used later, so the service representative is not looked up.
    """
    wanted = churns.select(
        "svc_inst_id",
        F.col("bolton_rate_plan_cd").alias("component_id"),
        F.col("bolton_active_dt").alias("cmp_active_dt"),
    ).distinct()
    known = touched_by(t["oo_svcins"].select("svc_inst_id"), churns, [("svc_inst_id", "svc_inst_id")])
    wanted = keep(semi_join(wanted, known, "svc_inst_id", "svc_inst_id"), "original_wanted")
    orders = t["oo_wrkord"].filter(
        (F.col("work_ord_status").cast("string") == COMPLETED)
        & F.col("work_ord_type").isin(*START_ACTIONS)
        & ~F.col("svc_action_type").isin(*EXCLUDED_ACTION_TYPES)
    ).select("work_ord_no", "svc_inst_id", "work_ord_completion_dt", "work_ord_completion_tm", "dealer_cd")
    orders = keep(touched_by(orders, wanted, [("svc_inst_id", "svc_inst_id")]), "original_orders")
    components = (
        order_components(t, orders, START_ACTIONS, "active_dt")
        .filter(F.col("cmp_inactive_dt").isNull())
        .select("work_ord_no", "component_id", "cmp_active_dt")
    )
    components = touched_by(components, wanted, [(c, c) for c in ("component_id", "cmp_active_dt")]).distinct()
    candidates = orders.join(components, "work_ord_no").join(
        wanted, ["svc_inst_id", "component_id", "cmp_active_dt"], "left_semi"
    ).distinct()
    keys = ["component_id", "svc_inst_id"]
    newest = best_rows(candidates, keys, [latest("work_ord_completion_dt"), latest("work_ord_completion_tm")])
    newest = keep(newest, "original_newest")
    with_rep = temporal_join(
        newest, _order_reps(t), ["work_ord_no"], "work_ord_completion_dt", "oj_open", "oj_close", 2, "left", among=newest,
    )
    return best_rows(with_rep, keys, [earliest("oj_open")]).select(
        *keys, "cmp_active_dt", "work_ord_no", "dealer_cd", "wrkjn_rep_id"
    ).distinct()


def attach_original(churns: DataFrame, originals: DataFrame) -> DataFrame:
    """Dealer and representative of the original order next to each churn; duplicate rows collapse."""
    keys = {
        "svc_inst_id": "svc_inst_id",
        "component_id": "bolton_rate_plan_cd",
        "cmp_active_dt": "bolton_active_dt",
    }
    found = originals.select(
        *[F.col(k).alias(v) for k, v in keys.items()],
        F.col("dealer_cd").alias("original_dlr_cd"),
        F.col("wrkjn_rep_id").alias("original_rep_id"),
    ).distinct()
    return spread_join(churns, found, list(keys.values()), "left").distinct()


def order_fact(adds: DataFrame, churns: DataFrame, as_of: date) -> DataFrame:
    """Fact rows of the order source, de-duplicated on (service, order, day, plan)."""
    keys = ["svc_no", "work_ord_no", "work_ord_completion_dt", "bolton_rate_plan_cd"]
    common = {"load_date": as_of, "src_tbl": ORDER_SOURCE, "src_cd": "ID", "bcc_migrated_ind": "N"}
    return union_events(
        conform(best_rows(churns, keys, [latest("bolton_inactive_dt")]), EVENT_FACT, status_cd="Churns", **common),
        conform(best_rows(adds, keys, [latest("bolton_active_dt")]), EVENT_FACT, status_cd="Gross Adds", **common),
    )


def account_events(t: Tables, window: Span, kinds: str | Sequence[str], keep: Keep = stage) -> DataFrame:
    """Orders with account attributes and segment.  Stored, because two later steps read each table."""
    events = keep(addon_orders(t, window, kinds, keep), "addon_orders")
    return keep(derive_segment(t, attach_account(t, events, window)), "order_accounts")


def plan_events(t: Tables, window: Span, kinds: str | Sequence[str], keep: Keep = stage) -> DataFrame:
    """Events with subscriber and basic plan, named as in the fact; ``kind`` tells adds from churns."""
    events = account_events(t, window, kinds, keep)
    subscribers = keep(lookup_subscriber(t, events, window), "order_subscribers")
    return consolidate(events, lookup_basic_plan(t, subscribers, window))


def order_events(t: Tables, window: Span, as_of: date, keep: Keep = stage) -> DataFrame:
    """All add-on adds and churns of the window, ready to replace the order slice of the fact.

    ``keep`` stores a table that several later steps read; each step is then one plan over scans, which reads a source table once.
    """
    events = keep(plan_events(t, window, KINDS, keep), "order_plans")
    adds, churns = (events.filter(F.col("kind") == k).drop("kind") for k in KINDS)
    return order_fact(adds, attach_original(churns, original_order(t, churns, keep)), as_of)
