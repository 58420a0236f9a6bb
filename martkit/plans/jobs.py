"""Whole jobs: load windows and months into partitioned facts, rewrite a script corpus."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from martkit.functions.dates import prev_month_end, rolling_window
from martkit.operators.change import days_in, write_slice
from martkit.operators.names import derive_name_map, rewrite_names
from martkit.operators.shape import conform, union_events
from martkit.plans import base, order_events, revenue, second_source, staged_events, tv_events
from martkit.plans.order_events import Keep
from martkit.sources.schemas import EVENT_FACT, MONTH_BASE
from martkit.sources.tables import StageArea, read_scripts, stage, write_scripts

Tables = Mapping[str, DataFrame]

# The source table of an event, as a folder: rows of the second source name none.
SOURCE_PART = "src_part"
SECOND_PART = "second_source"
OWNED_PARTS = [
    order_events.ORDER_SOURCE, tv_events.TV_SOURCE, staged_events.FBB_SOURCE, staged_events.DATA_SOURCE,
    staged_events.BLACKBERRY_SOURCE, staged_events.ACCOUNT_SOURCE, SECOND_PART,
]
EVENT_PARTITIONS = [SOURCE_PART, "work_ord_completion_dt"]
BASE_PARTITIONS = ["src_cd", "per_end_dt"]
SOURCES = ["ID", "ED"]


def source_part() -> Column:
    """Folder name of an event's source table; every table has one of its own."""
    return F.coalesce(F.col("src_tbl"), F.lit(SECOND_PART))


def read_fact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A loaded fact with its declared types; filters on the partition columns prune folders."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def first_source_events(
    t: Tables, window: tuple[date, date], as_of: date, keep: Keep = stage
) -> DataFrame:
    """Rows of all first-source slices of the window with service counts filled in."""
    # Stored, because the as-of join reads the events twice.
    television = tv_events.attach_order_dealer(t, keep(tv_events.tv_events(t, window), "tv_events"))
    rows = keep(
        union_events(
            order_events.order_events(t, window, as_of, keep),
            tv_events.tv_fact(tv_events.attach_customer_name(t, television), as_of),
            staged_events.load_fbb(t, window, as_of),
            staged_events.load_mobile_data(t, window, as_of),
            staged_events.load_blackberry(t, window, as_of),
            staged_events.account_addon_events(t, window, as_of, keep),
        ),
        "first_source",
    )
    counts = staged_events.services_per_account(t, rows, window)
    return staged_events.apply_services_per_account(rows, counts, window)


def run_daily_load(
    spark: SparkSession, t: Tables, fact_path: str, as_of: date, back: int = 12, lag: int = 2
) -> None:
    """Reload the window of the event fact: both sources, overlap flagged, in one slice replace.

    Counts and flags are set before the write, so the loaded partitions are written once.  Slices are those of
    the source tables this job rebuilds; other tables' rows of the same days stay.
    """
    window = rolling_window(as_of, back, lag)
    with StageArea(spark) as keep:
        second = conform(
            second_source.map_second_source_events(t, window), EVENT_FACT, bcc_migrated_ind="N"
        )
        rows = keep(union_events(first_source_events(t, window, as_of, keep), second), "events")
        flagged = second_source.flag_migrated_events(rows)
        parted = keep(flagged.withColumn(SOURCE_PART, source_part()), "events_flagged")
        write_slice(
            parted, fact_path, EVENT_PARTITIONS,
            {SOURCE_PART: OWNED_PARTS, "work_ord_completion_dt": days_in(window)},
        )


def run_month_end(
    spark: SparkSession, t: Tables, base_path: str, account_plan_path: str, as_of: date
) -> None:
    """Replace the month in the subscriber base (both sources, overlap flagged) and the account plan base."""
    month = prev_month_end(as_of)
    with StageArea(spark) as keep:
        second = conform(second_source.map_second_source_base(t, month), MONTH_BASE, bcc_migrated_ind="N")
        rows = keep(union_events(base.month_base(t, month, keep), second), "base_both")
        flagged = keep(second_source.flag_migrated_base(rows), "base_flagged")
        write_slice(flagged, base_path, BASE_PARTITIONS, {"src_cd": SOURCES, "per_end_dt": [month]})
        plans = keep(base.account_plan_base(t, month), "account_plan_base")
        write_slice(plans, account_plan_path, ["per_end_dt"], {"per_end_dt": [month]})


def run_second_source_stage(
    spark: SparkSession, t: Tables, event_stage_path: str, base_stage_path: str, as_of: date, back: int = 12, lag: int = 2
) -> None:
    """Write the staging facts of the second source: the window's events by day, and the month's base.

    ``load_second_source_events`` and ``load_second_source_base`` load the facts from them.
    """
    window, month = rolling_window(as_of, back, lag), prev_month_end(as_of)
    with StageArea(spark) as keep:
        events = keep(second_source.map_second_source_events(t, window), "event_stage")
        write_slice(events, event_stage_path, ["work_ord_completion_dt"], {"work_ord_completion_dt": days_in(window)})
        rows = keep(second_source.map_second_source_base(t, month), "base_stage")
        write_slice(rows, base_stage_path, ["per_end_dt"], {"per_end_dt": [month]})


def run_television_load(spark: SparkSession, t: Tables, fact_path: str, as_of: date, back: int = 15, lag: int = 2) -> None:
    """Reload the television slice with the older rule: four kinds of events, the first order counts, fifteen days."""
    window = rolling_window(as_of, back, lag)
    with StageArea(spark) as keep:
        rows = keep(tv_events.tv_events_four_way(t, window, as_of).withColumn(SOURCE_PART, source_part()), "television")
        days = {SOURCE_PART: [tv_events.TV_SOURCE], "work_ord_completion_dt": days_in(window)}
        write_slice(rows, fact_path, EVENT_PARTITIONS, days)


def run_commission_revenue(spark: SparkSession, t: Tables, fact_path: str, as_of: date) -> None:
    """Replace the month's billed revenue in the commission fact."""
    month = prev_month_end(as_of)
    with StageArea(spark) as keep:
        rows = keep(revenue.commission_revenue(t, month), "commission_revenue")
        write_slice(
            rows, fact_path, ["record_type", "day_dt"], {"record_type": [revenue.RECORD_TYPE], "day_dt": [month]}
        )


def run_retarget(
    spark: SparkSession, scripts_path: str, names: DataFrame, from_letter: str, to_letter: str, out_path: str
) -> None:
    """Rewrite the database names of one environment to another in all scripts below a folder."""
    docs = read_scripts(spark, scripts_path)
    write_scripts(rewrite_names(docs, derive_name_map(names, from_letter, to_letter)), out_path)
