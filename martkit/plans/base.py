"""Month-end subscriber base: one row per service, add-on and basic plan."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from martkit.functions.dates import HIGH_DATE, LOW_DATE, or_high, same_month
from martkit.functions.predicates import current_rows, folded, in_interval, open_on, text_in, valid_at
from martkit.functions.text import varchar
from martkit.operators.change import drop_null_keys, replace_slice, update_from
from martkit.operators.hot import listed, touched_by
from martkit.operators.joins import semi_join, spread_join
from martkit.operators.pick import best_rows, earliest, latest
from martkit.operators.profile import count_by_class
from martkit.operators.shape import conform, union_events
from martkit.plans.order_events import START_ACTIONS, VOID_RECORD, Keep, basic_packages
from martkit.sources.schemas import MONTH_BASE
from martkit.sources.tables import stage

Tables = Mapping[str, DataFrame]

# Plan codes handled apart, order states that count, account plan types.
EXCLUDED_PLAN = "700120"
EXTRA_PLANS = ("601952", "601869", "601975", "601870", "601976", "602331", "602329", "602330")
PLACED_ORDERS = ("2", "3", "4", "9")
ACCOUNT_PLAN_TYPES = ("Voice Plan", "Data Plan")
MOBILE = 20


def addon_plan_list(t: Tables, extra: tuple[str, ...] = EXTRA_PLANS) -> DataFrame:
    """Flagged add-on plans without the excluded code, and the listed plans of the reference."""
    code = F.col("rate_plan_cd")
    flagged = t["bolton_rp_ref"].filter((F.col("bolton_in") == "1") & (code != EXCLUDED_PLAN))
    listed = t["zz_cfg_rate_plan_ref"].filter(code.isin(*extra))
    return union_events(*[p.select("rate_plan_cd", "rate_plan_ds") for p in (flagged, listed)])


def basic_plan_list(t: Tables) -> DataFrame:
    """Components of the basic-plan package groups, with their names."""
    members = current_rows(t["ar_package_components"]).select("package_id", "component_id")
    names = current_rows(t["ar_component_definition_values"]).select(
        "component_id", F.col("component_id_dv").alias("basic_plan_ds")
    )
    return (
        basic_packages(t)
        .join(members, "package_id")
        .join(names, "component_id")
        .select("component_id", "basic_plan_ds", "package_group")
        .distinct()
    )


def _held_at(t: Tables, per_end_dt: date) -> DataFrame:
    """Subscriber components held at month end; all bounds are literals, so the scan filters."""
    day = F.lit(per_end_dt)
    return t["ar_p200"].filter(
        open_on(per_end_dt, F.col("product_start"), F.col("product_stop"))
        & (F.col("open_dt") <= F.lit(per_end_dt + timedelta(days=2)))
        & (F.col("close_dt") >= day)
    ).select(
        "subscr_no", "account_no", "component_id", "product_start", "product_stop",
        "cce_active_dt", "cce_inactive_dt", "open_dt", "close_dt",
    )


def active_addons(t: Tables, per_end_dt: date, plans: DataFrame) -> DataFrame:
    """Add-on components held at month end, best per (subscriber, component)."""
    codes = listed(plans.select(F.col("rate_plan_cd").alias("_code")).distinct())
    held = _held_at(t, per_end_dt)
    held = held.join(codes, varchar(F.col("component_id"), 6) == F.col("_code"), "left_semi")
    order = [latest("cce_active_dt"), latest("cce_inactive_dt", HIGH_DATE)]
    # Copies of a row tie and stay, as many as there are; the scan is cheap to read twice.
    picked = best_rows(held, ["subscr_no", "component_id"], order, spread_ties=True)
    return picked.drop("open_dt", "close_dt")


def active_basic_plan(t: Tables, per_end_dt: date, addons: DataFrame, basics: DataFrame) -> DataFrame:
    """One basic plan per subscriber that holds an add-on."""
    # The codes go to the rows before anything is shuffled; copies collapse where the pick has gathered them, without a shuffle.
    codes = listed(basics.select("component_id").distinct())
    held = _held_at(t, per_end_dt).join(codes, "component_id", "left_semi")
    held = semi_join(held, addons, "subscr_no", "subscr_no", early=True)
    order = [
        latest("cce_active_dt"), latest("cce_inactive_dt", HIGH_DATE),
        latest("product_start"), latest("product_stop", HIGH_DATE),
        latest("open_dt"), latest("close_dt"), latest("component_id"),
    ]
    return best_rows(held, ["subscr_no"], order).distinct()


def active_service(t: Tables, per_end_dt: date, addons: DataFrame) -> DataFrame:
    """Service id of each subscriber at month end, with its product name."""
    day = F.lit(per_end_dt)
    subscribers = t["ar_s100"].filter(
        valid_at(day, F.col("open_dt"), F.col("close_dt"), 2)
        & (F.col("record_type").cast("string") != VOID_RECORD)
    ).select(
        "subscr_no", "emf_config_id", "display_external_id_type", F.col("open_dt").alias("s100_open")
    )
    ids = t["ar_s200"].filter(
        valid_at(day, F.col("open_dt"), F.col("close_dt"), 2)
        & open_on(per_end_dt, F.col("active_date"), F.col("inactive_date"))
        & (F.col("record_type").cast("string") != VOID_RECORD)
    ).select(
        "subscr_no", "external_id", F.col("external_id_type").cast("smallint").alias("external_id_type"),
        "active_date", "inactive_date", F.col("open_dt").alias("s200_open"),
    )
    ids = touched_by(ids, addons, [("subscr_no", "subscr_no")])
    named = semi_join(subscribers, addons, "subscr_no", "subscr_no", early=True).join(ids, "subscr_no").filter(
        F.col("display_external_id_type").cast("smallint") == F.col("external_id_type")
    )
    picked = best_rows(
        named,
        ["subscr_no"],
        [
            latest("active_date"), latest("inactive_date", HIGH_DATE),
            latest("s200_open"), latest("s100_open"),
        ],
    ).select(
        "subscr_no", "external_id", "external_id_type", "emf_config_id", "active_date", "inactive_date",
        F.lit(None).cast("string").alias("product"),
    )
    names = current_rows(t["ar_emf_config_id_values"])
    return update_from(picked, names, [("emf_config_id", "emf_config_id")], {"product": "display_value"}, codes=True)


def month_end_account(t: Tables, per_end_dt: date, addons: DataFrame) -> DataFrame:
    """Account attributes at month end, best per account number."""
    accounts = t["ar_a100"].filter(valid_at(F.lit(per_end_dt), F.col("open_dt"), F.col("close_dt"), 2))
    accounts = semi_join(accounts, addons, "account_no", "account_no", early=True).select(
        "account_no", F.col("bill_lname").alias("customer_name"), "bill_zip", "vip_code",
        "owning_cost_ctr", "owning_cost_ctr_dv", "close_dt",
    )
    ids = current_rows(t["ar_a200"]).filter(F.col("external_id_type").cast("string") == "1").select(
        "account_no", F.col("external_id").alias("acct_no")
    )
    return best_rows(accounts.join(ids, "account_no"), ["acct_no"], [latest("close_dt")]).drop("close_dt")


def assemble_base(
    addons: DataFrame, basic: DataFrame, services: DataFrame, accounts: DataFrame,
    plans: DataFrame, basics: DataFrame, per_end_dt: date,
) -> DataFrame:
    """Add-ons with basic plan, service and account; one row per (service, add-on, basic plan).

    Rows without a service id are dropped before the pick: the service id is part of its key, so the pick
    among the others is the same and the group of missing ids is never gathered.
    """
    addon_rows = addons.select(
        "subscr_no", "account_no", "product_start",
        F.col("cce_active_dt").cast("date").alias("svc_start_date"),
        varchar(F.col("component_id"), 15).alias("bolton_rate_plan_cd"),
    )
    basic_rows = basic.select("subscr_no", varchar(F.col("component_id"), 15).alias("basic_rate_plan_cd"))
    service_rows = services.select(
        "subscr_no", F.col("external_id").alias("svc_no"), "product", "external_id_type"
    )
    # Without a service row the service id is missing, so an inner join already drops those rows.
    joined = drop_null_keys(spread_join(addon_rows, service_rows, ["subscr_no"], "inner"), ["svc_no"])
    joined = spread_join(joined, basic_rows, ["subscr_no"], "left")
    joined = spread_join(
        joined, accounts.withColumnRenamed("bill_zip", "post_cd"), ["account_no"], "left"
    )
    picked = best_rows(
        joined,
        ["svc_no", "bolton_rate_plan_cd", "basic_rate_plan_cd"],
        [latest("svc_start_date"), latest("product_start")],
        ties=False,
    ).withColumnsRenamed({"subscr_no": "ar_subscr_no", "account_no": "ar_account_no"})
    base = conform(picked, MONTH_BASE, per_end_dt=per_end_dt, src_cd="ID", bcc_migrated_ind="N")
    # A plan with two names is an error of the reference tables, and fails the job.
    base = update_from(
        base, plans.distinct(), [("bolton_rate_plan_cd", "rate_plan_cd")], {"bolton_rate_plan_ds": "rate_plan_ds"}, codes=True
    )
    named_basics = basics.select(
        F.col("component_id").cast("string").alias("component_id"), "basic_plan_ds"
    ).distinct()
    return update_from(
        base, named_basics, [("basic_rate_plan_cd", "component_id")], {"basic_plan_ds": "basic_plan_ds"}, codes=True
    )


def base_order(t: Tables, base: DataFrame, per_end_dt: date) -> DataFrame:
    """Best add order per (service, add-on) near month end; orders not yet active count too."""
    day = F.lit(per_end_dt)
    wanted = base.select("svc_no", F.col("bolton_rate_plan_cd").alias("component_id")).distinct()
    ids = t["oo_svciex"].filter(or_high(F.col("end_dt")) >= day).select(
        "svc_inst_id", F.col("ext_id").alias("svc_no")
    )
    ids = semi_join(ids, base, "svc_no", "svc_no", early=True).distinct()
    orders = t["oo_wrkord"].filter(
        F.col("work_ord_status").cast("string").isin(*PLACED_ORDERS)
        & F.col("work_ord_type").isin(*START_ACTIONS)
        & (F.col("work_ord_create_dt") <= F.lit(per_end_dt + timedelta(days=5)))
    ).select(
        "work_ord_no", "dealer_cd", "svc_inst_id", "work_ord_status",
        "work_ord_create_dt", "work_ord_create_tm", "work_ord_completion_dt", "work_ord_completion_tm",
    )
    components = t["oo_btxncm"].filter(
        F.col("bill_product_action").isin(*START_ACTIONS)
        & (
            F.col("active_dt").isNull()
            | in_interval(day, F.date_sub("active_dt", 15), F.col("inactive_dt"))
        )
    ).select(
        "int_pack_inst", F.col("component_id").cast("string").alias("component_id"), "active_dt", "inactive_dt"
    )
    components = touched_by(components, base, [("component_id", "bolton_rate_plan_cd")])
    # Orders of other services go first, then packages of other orders: neither is shuffled whole.
    orders = touched_by(orders, ids, [("svc_inst_id", "svc_inst_id")])
    packages = touched_by(t["oo_btxnpa"].select("work_ord_no", "int_pack_inst"), orders, [("work_ord_no", "work_ord_no")])
    found = (
        orders.join(ids, "svc_inst_id")
        .join(packages, "work_ord_no")
        .join(components, "int_pack_inst")
        .drop("int_pack_inst")
        .join(wanted, ["svc_no", "component_id"], "left_semi")
    )
    order = [
        latest("work_ord_create_dt", HIGH_DATE), latest("work_ord_create_tm"),
        earliest("active_dt", HIGH_DATE), latest("work_ord_status"),
        latest("work_ord_completion_dt", LOW_DATE), latest("work_ord_completion_tm"), latest("work_ord_no"),
    ]
    return best_rows(found, ["svc_no", "component_id"], order, ties=False)


def base_order_attribution(base: DataFrame, orders: DataFrame) -> DataFrame:
    return update_from(
        base,
        orders,
        [("svc_no", "svc_no"), ("bolton_rate_plan_cd", "component_id")],
        {"work_ord_no": "work_ord_no", "dlr_cd": "dealer_cd", "svc_inst_id": "svc_inst_id"},
    )


def first_order_rep(t: Tables, orders: DataFrame) -> DataFrame:
    """First history row of each attributed order."""
    history = semi_join(t["oo_wrkojn"], orders, "work_ord_no", "work_ord_no", early=True).select(
        "work_ord_no", "reps_id", "sales_chanl_id", "retl_store", "acq_partnr_cmpny", "open_dt"
    )
    return best_rows(history, ["work_ord_no"], [earliest("open_dt")], ties=False)


def base_rep_attribution(base: DataFrame, reps: DataFrame) -> DataFrame:
    return update_from(
        base,
        reps,
        [("work_ord_no", "work_ord_no")],
        {
            "rep_id": "reps_id", "sales_chanl_id": "sales_chanl_id", "retl_store": "retl_store",
            "acq_partnr_cmpny": "acq_partnr_cmpny",
        },
    )


def base_service_counts(t: Tables, base: DataFrame, per_end_dt: date) -> DataFrame:
    """Live services per account at month end, mobile and fixed in one pass."""
    day = F.lit(per_end_dt)
    live = t["ar_s100"].filter(
        (F.col("record_type").cast("string") != VOID_RECORD)
        & open_on(per_end_dt, F.col("service_start"), F.col("service_end"))
        & valid_at(day, F.col("open_dt"), F.col("close_dt"), 2)
    ).select(
        "subscr_no", "account_no", F.col("display_external_id_type").cast("smallint").alias("id_type"),
        "open_dt", "close_dt",
    )
    live = semi_join(live, base, "account_no", "ar_account_no", early=True)
    one = best_rows(live, ["subscr_no"], [latest("open_dt"), latest("close_dt")], ties=False)
    return count_by_class(one, ["account_no"], "id_type", MOBILE, "mobile_count", "fixed_count")


def apply_service_counts(base: DataFrame, counts: DataFrame) -> DataFrame:
    """Mobile rows take the mobile count and other rows the fixed count; a class without services sets nothing."""
    spread = counts.select(
        "account_no",
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("mobile"), F.col("mobile_count").cast("int").alias("n")),
                F.struct(F.lit(False).alias("mobile"), F.col("fixed_count").cast("int").alias("n")),
            )
        ),
    ).filter(F.col("n") > 0)
    marked = base.withColumn("_mobile", F.col("external_id_type") == MOBILE)
    done = update_from(
        marked, spread, [("ar_account_no", "account_no"), ("_mobile", "mobile")], {"no_of_x_svc": "n"}
    )
    return done.drop("_mobile")


def base_segment(t: Tables, base: DataFrame) -> DataFrame:
    """Segment by VIP code; both sides compare as text."""
    classes = t["cfg_sales_class_ref"].select(
        folded(F.col("sales_class_ref_cd").cast("string")).alias("class_cd"), "cfu"
    )
    keyed = base.withColumn("_vip", folded(F.col("vip_code").cast("string")))
    return update_from(keyed, classes, [("_vip", "class_cd")], {"cfu": "cfu"}, codes=True).drop("_vip")


def load_base(fact: DataFrame, base: DataFrame, per_end_dt: date) -> DataFrame:
    """Replace the month."""
    return replace_slice(fact, base, F.col("per_end_dt") == F.lit(per_end_dt))


def account_plan_base(t: Tables, per_end_dt: date) -> DataFrame:
    """Account plans live at month end that did not start and end in one month, newest per plan type."""
    plans = t["f_tbc_acct_plans"].filter(
        text_in(F.col("plan_type"), *ACCOUNT_PLAN_TYPES)
        & F.lit(per_end_dt).between(F.col("plan_active_dt"), F.col("plan_inactive_dt"))
        & ~same_month(F.col("plan_active_dt"), F.col("plan_inactive_dt"))
    )
    typed = plans.withColumn("_type", folded(F.col("plan_type")))
    picked = best_rows(typed, ["acct_no", "_type"], [latest("plan_active_dt")], ties=False)
    return picked.select(F.lit(per_end_dt).alias("per_end_dt"), *plans.columns)


def month_base(t: Tables, per_end_dt: date, keep: Keep = stage) -> DataFrame:
    """The whole month-end base, ready to replace the month.

    ``keep`` stores the tables that later steps read several times.
    """
    plans, basics = addon_plan_list(t), basic_plan_list(t)
    addons = keep(active_addons(t, per_end_dt, plans), "base_addons")
    base = keep(
        assemble_base(
            addons,
            active_basic_plan(t, per_end_dt, addons, basics),
            active_service(t, per_end_dt, addons),
            month_end_account(t, per_end_dt, addons),
            plans,
            basics,
            per_end_dt,
        ),
        "base_rows",
    )
    orders = keep(base_order(t, base, per_end_dt), "base_orders")
    out = base_order_attribution(base, orders)
    out = base_rep_attribution(out, first_order_rep(t, orders))
    out = apply_service_counts(out, base_service_counts(t, base, per_end_dt))
    return base_segment(t, out)
