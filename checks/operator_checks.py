"""One check per relational and scalar operator."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.harness import check
from martkit.functions.dates import (
    HIGH_DATE, iso_text, month_label, or_high, prev_month_end, rolling_window, same_month,
)
from martkit.functions.predicates import current_rows, in_interval, on_days, same_text, text_in, valid_at
from martkit.functions.text import PRODUCT_ACTIONS, decode_case, mid_token, varchar, whole_number_text
from martkit.operators import change, joins, names, profile, shape
from martkit.operators.pick import best_rows, earliest, latest
from martkit.sources.schemas import EVENT_FACT

AS_OF = date(1998, 9, 1)
WINDOW = rolling_window(AS_OF)
SPAN = "BETWEEN DATE '1998-08-20' AND DATE '1998-08-30'"
MONTH_END = date(1998, 8, 31)


@check("rolling_window_filter", "work_ord_no:i acct_id:i completion_dt:t",
       f"SELECT * FROM wo WHERE completion_dt {SPAN}")
def _(t):
    return t["wo"].filter(F.col("completion_dt").between(*map(F.lit, WINDOW)))


@check("prev_month_end", "work_ord_no:i per_end_dt:t",
       "SELECT work_ord_no, CAST(date_trunc('month', completion_dt) AS DATE) - 1 AS per_end_dt FROM wo")
def _(t):
    return t["wo"].select("work_ord_no", prev_month_end(F.col("completion_dt")).alias("per_end_dt"))


@check("slice_replace", "work_ord_no svc_no work_ord_completion_dt:t src_cd bcc_migrated_ind", """
SELECT * FROM two_source WHERE NOT (src_cd = 'ED' AND work_ord_completion_dt >= DATE '1998-01-01')
UNION ALL
SELECT 'n' || work_ord_no, svc_no, work_ord_completion_dt, per_end_dt, 'ED', 'Y'
FROM two_source WHERE src_cd = 'ID' AND work_ord_completion_dt >= DATE '1998-01-01'""")
def _(t):
    fact = t["two_source"]
    recent = F.col("work_ord_completion_dt") >= F.lit(date(1998, 1, 1))
    new = shape.extend(
        fact.filter(recent & (F.col("src_cd") == "ID")),
        work_ord_no=F.concat(F.lit("n"), "work_ord_no"),
        src_cd=F.lit("ED"),
        bcc_migrated_ind=F.lit("Y"),
    )
    return change.replace_slice(fact, new, recent & (F.col("src_cd") == "ED"))


@check("conform_event",
       "work_ord_no svc_inst_id work_ord_completion_dt:t dealer_cd rep_id subscr_no:t load_date:t src_tbl src_cd", """
SELECT work_ord_no, svc_inst_id, work_ord_completion_dt, dealer_cd, CAST(NULL AS VARCHAR) AS rep_id,
       CAST(NULL AS INT) AS subscr_no, DATE '1998-09-01' AS load_date, 'orders' AS src_tbl, 'ID' AS src_cd
FROM oo_wrkord""")
def _(t):
    return shape.conform(t["oo_wrkord"], EVENT_FACT, load_date=AS_OF, src_tbl="orders", src_cd="ID")


@check("column_profile", "column_name row_count:i null_count:i distinct_count:i min_value max_value", """
SELECT 'component_id' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT(component_id) AS null_count,
       COUNT(DISTINCT component_id) AS distinct_count, CAST(MIN(component_id) AS VARCHAR) AS min_value,
       CAST(MAX(component_id) AS VARCHAR) AS max_value FROM cmp
UNION ALL
SELECT 'inactive_dt', COUNT(*), COUNT(*) - COUNT(inactive_dt), COUNT(DISTINCT inactive_dt),
       CAST(MIN(inactive_dt) AS VARCHAR), CAST(MAX(inactive_dt) AS VARCHAR) FROM cmp""")
def _(t):
    return profile.column_profile(t["cmp"], ["component_id", "inactive_dt"])


_PROFILED = ("component_id", "active_dt", "action")


@check("slice_profile", "column_name row_count:i null_count:i min_value max_value distinct_near:i", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, CAST(MIN({c}) AS VARCHAR) AS min_value,"
    f" CAST(MAX({c}) AS VARCHAR) AS max_value, 1 AS distinct_near FROM cmp" for c in _PROFILED))
def _(t):
    # Statistics of each slice first, then the table's from them; the estimate is held against the exact count.
    sketches = profile.slice_sketches(t["cmp"], _PROFILED, ["line_no"])
    merged = profile.merged_profile(sketches, t["cmp"].schema)
    exact = profile.column_profile(t["cmp"], _PROFILED).select("column_name", "distinct_count")
    near = F.abs(F.col("about_distinct") - F.col("distinct_count")) <= 1 + 0.1 * F.col("distinct_count")
    return merged.join(exact, "column_name").withColumn("distinct_near", near.cast("int"))


# Five keys hold all rows of both sides.
@check("temporal_join_crowded", "work_ord_no:i n:i last_line:i", """
SELECT w.work_ord_no, COUNT(*) AS n, MAX(v.line) AS last_line
FROM (SELECT o_orderkey AS work_ord_no, o_custkey % 5 AS k, CAST(o_orderdate AS DATE) AS day FROM orders) w
JOIN (SELECT l_orderkey * 8 + l_linenumber AS line, l_suppkey % 5 AS k, CAST(l_shipdate AS DATE) AS a, CAST(l_shipdate AS DATE) + CAST(l_suppkey % 17 AS INT) AS b FROM lineitem
      WHERE l_linenumber = 1) v
  ON v.k = w.k AND w.day BETWEEN v.a - 2 AND v.b
GROUP BY w.work_ord_no""")
def _(t):
    left = t["orders"].select(F.col("o_orderkey").alias("work_ord_no"), (F.col("o_custkey") % 5).alias("k"), F.col("o_orderdate").cast("date").alias("day"))
    right = t["lineitem"].filter("l_linenumber = 1").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"), (F.col("l_suppkey") % 5).alias("k"),
        F.col("l_shipdate").cast("date").alias("a"), F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_suppkey") % 17).cast("int")).alias("b"),
    )
    # What is valid depends on the key and the day alone: orders of one day share their versions, which are summed up before them.
    asked = left.select("k", "day").distinct()
    heavy = joins.heavy_keys(asked, right, ["k"])
    joined = joins.temporal_join(asked, right, ["k"], "day", "a", "b", grace=2, heavy=heavy)
    valid = joined.groupBy("k", "day").agg(F.count(F.lit(1)).alias("n"), F.max("line").alias("last_line"))
    orders = joins.spread_join(left, valid, ["k", "day"], "inner")
    return orders.groupBy("work_ord_no").agg(F.sum("n").alias("n"), F.max("last_line").alias("last_line"))


@check("duplicate_keys", "work_ord_no:i line_no:i row_count:i",
       "SELECT work_ord_no, line_no, COUNT(*) AS row_count FROM cmp GROUP BY 1, 2 HAVING COUNT(*) > 1")
def _(t):
    return profile.duplicate_keys(t["cmp"], ["work_ord_no", "line_no"])


@check("scd2_current", "acct_id:i open_dt:t vip_code",
       "SELECT * FROM acct_hist WHERE close_dt = DATE '2899-12-31'")
def _(t):
    return current_rows(t["acct_hist"])


@check("scd2_as_of_grace", "acct_id:i open_dt:t close_dt:t",
       "SELECT * FROM acct_hist WHERE DATE '1998-08-31' >= open_dt - 15 AND close_dt >= DATE '1998-08-31'")
def _(t):
    return t["acct_hist"].filter(valid_at(F.lit(MONTH_END), F.col("open_dt"), F.col("close_dt"), 15))


@check("open_interval", "work_ord_no:i component_id:i active_dt:t inactive_dt:t", """
SELECT * FROM cmp WHERE active_dt <= DATE '1998-08-31'
   AND (inactive_dt IS NULL OR DATE '1998-08-31' <= inactive_dt + 3)""")
def _(t):
    return t["cmp"].filter(in_interval(F.lit(MONTH_END), F.col("active_dt"), F.col("inactive_dt"), 3))


@check("in_lists", "work_ord_no svc_action_type work_ord_type",
       "SELECT * FROM oo_wrkord WHERE svc_action_type NOT IN ('40', '1') AND work_ord_type IN ('1', '2')")
def _(t):
    return t["oo_wrkord"].filter(
        ~F.col("svc_action_type").isin("40", "1") & F.col("work_ord_type").isin("1", "2")
    )


@check("null_predicates", "work_ord_no:i component_id:i inactive_dt:t", """
SELECT * FROM cmp WHERE action <> '1' AND (inactive_dt IS NULL OR inactive_dt <= DATE '1998-08-30')
  AND component_id IS NOT NULL""")
def _(t):
    ended = F.col("inactive_dt").isNull() | (F.col("inactive_dt") <= F.lit(WINDOW[1]))
    return t["cmp"].filter((F.col("action") != "1") & ended & F.col("component_id").isNotNull())


@check("scalar_subquery_between", "work_ord_no:i component_id:i active_dt:t", """
SELECT * FROM cmp WHERE active_dt BETWEEN (SELECT MIN(completion_dt) FROM wo) AND (SELECT MAX(completion_dt) FROM wo)""")
def _(t):
    return t.sql(
        "SELECT * FROM cmp WHERE active_dt BETWEEN (SELECT MIN(completion_dt) FROM wo)"
        " AND (SELECT MAX(completion_dt) FROM wo)"
    )


@check("alias_reuse", "work_ord_no:i days_late:i", """
SELECT * FROM (SELECT work_ord_no, date_diff('day', active_dt, inactive_dt + 4) AS days_late FROM cmp) x
WHERE days_late > 3""")
def _(t):
    late = F.datediff(F.date_add("inactive_dt", 4), "active_dt")
    return shape.extend(t["cmp"], days_late=late).filter(F.col("days_late") > 3)


@check("wildcard_extend", "work_ord_no:i acct_id:i completion_dt:t status vip_text load_date:t",
       "SELECT *, 'vip ' || priority AS vip_text, DATE '1998-09-01' AS load_date FROM wo")
def _(t):
    return shape.extend(t["wo"], vip_text=F.concat(F.lit("vip "), "priority"), load_date=F.lit(AS_OF))


@check("drop_null_keys", "work_ord_no:i part_name:t", """
SELECT c.work_ord_no, p.p_name AS part_name FROM cmp c JOIN part p
  ON c.component_id = p.p_partkey AND p.p_size > 25 WHERE p.p_name IS NOT NULL""")
def _(t):
    named = t["part"].filter("p_size > 25").select(
        F.col("p_partkey").alias("component_id"), F.col("p_name").alias("part_name")
    )
    return change.drop_null_keys(t["cmp"].join(named, "component_id", "left"), ["part_name"])


@check("inner_join", "work_ord_no:i acct_id:i component_id:i",
       "SELECT w.work_ord_no, w.acct_id, c.component_id FROM wo w, cmp c WHERE c.work_ord_no = w.work_ord_no")
def _(t):
    return t["wo"].join(t["cmp"], "work_ord_no")


@check("left_join_on_filter", "work_ord_no:i component_id:t", """
SELECT w.work_ord_no, c.component_id FROM wo w
LEFT JOIN cmp c ON w.work_ord_no = c.work_ord_no AND c.action = '2'""")
def _(t):
    return t["wo"].join(t["cmp"].filter("action = '2'"), "work_ord_no", "left")


_TEMPORAL = "h.acct_id = w.acct_id AND w.completion_dt >= h.open_dt - 2 AND w.completion_dt <= h.close_dt"


@check("temporal_join_inner", "work_ord_no:i open_dt:t vip_code",
       f"SELECT w.work_ord_no, h.open_dt, h.vip_code FROM wo w INNER JOIN acct_hist h ON {_TEMPORAL}")
def _(t):
    return joins.temporal_join(t["wo"], t["acct_hist"], ["acct_id"], "completion_dt", grace=2)


@check("temporal_join_left", "work_ord_no:i component_id:i vip_code", """
SELECT c.work_ord_no, c.component_id, h.vip_code FROM cmp c LEFT JOIN acct_hist h
  ON h.acct_id = c.component_id AND c.active_dt >= h.open_dt - 3 AND c.active_dt <= h.close_dt""")
def _(t):
    right = t["acct_hist"].withColumnRenamed("acct_id", "component_id")
    return joins.temporal_join(t["cmp"], right, ["component_id"], "active_dt", grace=3, how="left")


@check("temporal_join_unbounded", "work_ord_no:i vip_code",
       f"SELECT w.work_ord_no, h.vip_code FROM wo w LEFT JOIN acct_hist h ON {_TEMPORAL}")
def _(t):
    return joins.temporal_join(t["wo"], t["acct_hist"], ["acct_id"], "completion_dt", grace=2, how="left")


def _moves(t):
    moves = t["ott_at_transaction"]
    left = moves.filter(same_text(F.col("action_type"), "activation")).select(
        "work_ord_no", "service_id", F.col("transaction_date").alias("day")
    )
    right = moves.filter(same_text(F.col("action_type"), "order")).select(
        "service_id", F.col("transaction_date").alias("order_day"), F.col("work_ord_no").alias("order_no")
    )
    return left, right


@check("asof_latest_order", "work_ord_no order_no:t order_day:t", """
SELECT a.work_ord_no, o.work_ord_no AS order_no, o.transaction_date AS order_day
FROM ott_at_transaction a LEFT JOIN ott_at_transaction o
  ON o.service_id = a.service_id AND o.action_type = 'Order' AND o.transaction_date <= a.transaction_date
WHERE a.action_type = 'ACTIVATION'
QUALIFY RANK() OVER (PARTITION BY a.work_ord_no ORDER BY o.transaction_date DESC NULLS LAST) = 1""")
def _(t):
    left, right = _moves(t)
    return joins.asof_join(left, right, ["service_id"], "day", "order_day")


@check("asof_earliest_order", "work_ord_no order_no:t order_day:t", """
SELECT a.work_ord_no, o.work_ord_no AS order_no, o.transaction_date AS order_day
FROM ott_at_transaction a LEFT JOIN ott_at_transaction o
  ON o.service_id = a.service_id AND o.action_type = 'Order' AND o.transaction_date <= a.transaction_date
WHERE a.action_type = 'ACTIVATION'
QUALIFY RANK() OVER (PARTITION BY a.work_ord_no ORDER BY o.transaction_date NULLS LAST) = 1""")
def _(t):
    left, right = _moves(t)
    return joins.asof_join(left, right, ["service_id"], "day", "order_day", pick="earliest")


@check("semi_join", "work_ord_no:i acct_id:i",
       "SELECT * FROM wo WHERE work_ord_no IN (SELECT work_ord_no FROM cmp WHERE action = '2' GROUP BY 1)")
def _(t):
    return joins.semi_join(t["wo"], t["cmp"].filter("action = '2'"), "work_ord_no", "work_ord_no")


@check("cross_join_param", "work_ord_no:i start_dt:t end_dt:t", """
SELECT work_ord_no, p.start_dt, p.end_dt FROM wo
CROSS JOIN (SELECT DATE '1998-08-20' AS start_dt, DATE '1998-08-30' AS end_dt) p""")
def _(t):
    return joins.cross_join_param(t["wo"], start_dt=WINDOW[0], end_dt=WINDOW[1])


@check("cross_source_match", "svc_no work_ord_completion_dt:t", """
SELECT DISTINCT a.svc_no, a.work_ord_completion_dt FROM two_source a JOIN two_source b
  ON a.svc_no = b.svc_no AND a.work_ord_completion_dt = b.work_ord_completion_dt
WHERE a.src_cd = 'ID' AND b.src_cd = 'ED' AND a.bcc_migrated_ind = 'N'""")
def _(t):
    return joins.cross_source_match(
        t["two_source"], ["svc_no", "work_ord_completion_dt"], first_when=F.col("bcc_migrated_ind") == "N"
    )


@check("null_safe_join", "gl:t prod:t rows:i", """
SELECT a.sap_gl AS gl, a.sap_prod_cd AS prod, COUNT(*) AS rows
FROM (SELECT * FROM f_mob_rev) a JOIN cfg_rev_ref b
  ON a.sap_gl IS NOT DISTINCT FROM b.sap_gl AND a.sap_prod_cd = b.sap_prod_cd
 AND a.bill_stmt_chrg_cd = b.bill_stmt_chrg_cd GROUP BY 1, 2""")
def _(t):
    right = shape.rename(
        t["cfg_rev_ref"], gl="sap_gl", prod="sap_prod_cd", chrg="bill_stmt_chrg_cd"
    )
    joined = joins.null_safe_join(
        t["f_mob_rev"], right, [("sap_gl", "gl")], [("sap_prod_cd", "prod"), ("bill_stmt_chrg_cd", "chrg")]
    )
    return joined.groupBy("gl", "prod").agg(F.count(F.lit(1)).alias("rows"))


@check("decode_twice", "work_ord_no action:t tariff:t", """
SELECT w.work_ord_no, a.decoded_value AS action, r.decoded_value AS tariff
FROM oo_wrkord w
LEFT JOIN oo_reftmc a ON lower(trim(a.mstr_cd_key_type)) = 'svc_action_ty' AND a.close_dt = DATE '2899-12-31'
      AND a.mstr_cd = w.svc_action_type
LEFT JOIN oo_reftmc r ON lower(trim(r.mstr_cd_key_type)) = 'rental_tariff_grp' AND r.close_dt = DATE '2899-12-31'
      AND r.mstr_cd = w.svc_inst_id""")
def _(t):
    out = joins.decode(t["oo_wrkord"], t["oo_reftmc"], "SVC_ACTION_TY", "svc_action_type", "action")
    return joins.decode(out, t["oo_reftmc"], "rental_tariff_grp ", "svc_inst_id", "tariff")


@check("cast_key_join", "subscr_no:i svc_inst_id work_ord_no", """
SELECT s.subscr_no, w.svc_inst_id, w.work_ord_no FROM ar_s100 s JOIN oo_wrkord w
  ON CAST(s.subscr_no AS VARCHAR) = w.svc_inst_id WHERE s.close_dt = DATE '2899-12-31'""")
def _(t):
    return joins.cast_key_join(current_rows(t["ar_s100"]), t["oo_wrkord"], "subscr_no", "svc_inst_id")


@check("outer_to_inner", "work_ord_no:i component_id:i part_name", """
SELECT c.work_ord_no, c.component_id, p.p_name AS part_name FROM cmp c
LEFT JOIN part p ON c.component_id = p.p_partkey WHERE p.p_size IN (3, 4, 5)""")
def _(t):
    parts = shape.rename(t["part"], component_id="p_partkey", part_name="p_name", size="p_size")
    return t["cmp"].join(parts, "component_id", "left").filter(F.col("size").isin(3, 4, 5))


@check("join_latest_dim", "work_ord_no:i vip_code", """
SELECT w.work_ord_no, h.vip_code FROM wo w JOIN
  (SELECT acct_id, vip_code, RANK() OVER (PARTITION BY acct_id ORDER BY open_dt DESC) AS r FROM acct_hist) h
  ON h.acct_id = w.acct_id AND h.r = 1""")
def _(t):
    newest = best_rows(t["acct_hist"], ["acct_id"], [latest("open_dt")]).select("acct_id", "vip_code")
    return joins.spread_join(t["wo"], newest, ["acct_id"], "inner")


@check("sum_by_month_key", "bill_yr_no:i bill_mnth_no:i svc_no net_amt:n", """
SELECT bill_yr_no, bill_mnth_no, svc_no, SUM(net_amt) AS net_amt FROM f_mob_rev GROUP BY 1, 2, 3""")
def _(t):
    return t["f_mob_rev"].groupBy("bill_yr_no", "bill_mnth_no", "svc_no").agg(F.sum("net_amt").alias("net_amt"))


@check("count_by_class", "account_no:i mobile_count:i fixed_count:i", """
SELECT account_no, COUNT(*) FILTER (WHERE display_external_id_type = 20) AS mobile_count,
       COUNT(*) FILTER (WHERE display_external_id_type <> 20) AS fixed_count FROM ar_s100 GROUP BY 1""")
def _(t):
    return profile.count_by_class(
        t["ar_s100"], ["account_no"], "display_external_id_type", 20, "mobile_count", "fixed_count"
    )


@check("count_distinct_group", "acct_id:i n_days:i n_status:i", """
SELECT acct_id, COUNT(DISTINCT completion_dt) AS n_days, COUNT(DISTINCT status) AS n_status FROM wo GROUP BY 1""")
def _(t):
    return t["wo"].groupBy("acct_id").agg(
        F.count_distinct("completion_dt").alias("n_days"), F.count_distinct("status").alias("n_status")
    )


@check("group_distinct", "acct_id:i status", "SELECT DISTINCT acct_id, status FROM wo")
def _(t):
    return t["wo"].select("acct_id", "status").distinct()


@check("union_sources", "work_ord_no:i src_tbl", """
SELECT work_ord_no, 'wo' AS src_tbl FROM wo UNION ALL SELECT work_ord_no, 'cmp' FROM cmp
UNION ALL SELECT work_ord_no, 'wo' FROM wo WHERE status = 'F'""")
def _(t):
    a = t["wo"].select("work_ord_no", F.lit("wo").alias("src_tbl"))
    b = t["cmp"].select(F.lit("cmp").alias("src_tbl"), "work_ord_no")
    c = t["wo"].filter("status = 'F'").select("work_ord_no", F.lit("wo").alias("src_tbl"))
    return shape.union_events(a, b, c)


@check("delete_where", "work_ord_no:i component_id:i inactive_dt:t", """
SELECT * FROM cmp WHERE inactive_dt IS NULL OR inactive_dt > DATE '1998-08-30'""")
def _(t):
    return change.delete_where(t["cmp"], F.col("inactive_dt") <= F.lit(WINDOW[1]))


_PICK = f"""
SELECT w.work_ord_no, w.acct_id, w.completion_dt, h.vip_code, h.open_dt FROM wo w JOIN acct_hist h
  ON h.acct_id = w.acct_id AND w.completion_dt BETWEEN h.open_dt - 2 AND h.close_dt
WHERE w.completion_dt {SPAN}
QUALIFY RANK() OVER (PARTITION BY w.work_ord_no ORDER BY w.completion_dt DESC, h.close_dt DESC) = 1"""


@check("latest_rank", "work_ord_no:i acct_id:i completion_dt:t vip_code open_dt:t", _PICK)
def latest_rank(t):
    orders = t["wo"].filter(F.col("completion_dt").between(*map(F.lit, WINDOW)))
    history = joins.alive_in(t["acct_hist"], WINDOW, grace=2)
    joined = joins.temporal_join(orders, history, ["acct_id"], "completion_dt", grace=2)
    return best_rows(joined, ["work_ord_no"], [latest("completion_dt"), latest("close_dt")])


@check("latest_rank_spread", "service_id action_type work_ord_no transaction_date:t", """
SELECT * FROM ott_at_transaction
QUALIFY RANK() OVER (PARTITION BY service_id, action_type ORDER BY transaction_date DESC, plan_name) = 1""")
def _(t):
    return best_rows(
        t["ott_at_transaction"],
        ["service_id", "action_type"],
        [latest("transaction_date"), earliest("plan_name")],
        spread_ties=True,
    )


@check("latest_row_number", "acct_id:i work_ord_no:i completion_dt:t status", """
SELECT * FROM wo QUALIFY ROW_NUMBER() OVER (PARTITION BY acct_id ORDER BY completion_dt DESC,
  work_ord_no DESC, status DESC, priority DESC, price DESC) = 1""")
def _(t):
    return best_rows(t["wo"], ["acct_id"], [latest("completion_dt")], ties=False)


@check("mixed_order_rank", "component_id:i work_ord_no:i active_dt:t inactive_dt:t", """
SELECT * FROM cmp QUALIFY RANK() OVER (PARTITION BY component_id ORDER BY action DESC,
  COALESCE(inactive_dt, DATE '2899-12-31') DESC, line_no ASC, COALESCE(inactive_dt, DATE '1901-01-01') ASC,
  active_dt DESC NULLS LAST) = 1""")
def _(t):
    order = [
        latest("action"), latest("inactive_dt", HIGH_DATE), earliest("line_no"),
        earliest("inactive_dt", date(1901, 1, 1)), latest("active_dt"),
    ]
    return best_rows(t["cmp"], ["component_id"], order)


@check("rank_after_distinct", "acct_id:i status completion_dt:t", """
SELECT * FROM (SELECT DISTINCT acct_id, status, completion_dt FROM wo) d
QUALIFY RANK() OVER (PARTITION BY acct_id ORDER BY completion_dt DESC) = 1""")
def _(t):
    rows = t["wo"].select("acct_id", "status", "completion_dt").distinct()
    return best_rows(rows, ["acct_id"], [latest("completion_dt")])


@check("rank_by_case", "event:t component_id:i work_ord_no:i active_dt:t", """
SELECT * FROM (SELECT *, CASE WHEN action IN ('1', '2') THEN 'add' ELSE 'churn' END AS event FROM cmp) c
QUALIFY RANK() OVER (PARTITION BY event, component_id ORDER BY active_dt ASC NULLS FIRST) = 1""")
def _(t):
    events = shape.extend(
        t["cmp"], event=F.when(F.col("action").isin("1", "2"), "add").otherwise("churn")
    )
    return best_rows(events, ["event", "component_id"], [earliest("active_dt")])


@check("update_lookup", "work_ord_no svc_no cfu:t", """
SELECT w.work_ord_no, w.svc_no, CASE WHEN c.c_custkey IS NULL THEN 'none' ELSE NULLIF(c.c_mktsegment, 'BUILDING') END AS cfu
FROM two_source w LEFT JOIN customer c ON 'S' || CAST(c.c_custkey AS VARCHAR) = w.svc_no AND c.c_acctbal > 2000""")
def _(t):
    target = t["two_source"].withColumn("cfu", F.lit("none"))
    source = t["customer"].filter("c_acctbal > 2000").select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("svc"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )
    return change.update_from(target, source, [("svc_no", "svc")], {"cfu": "segment"})


@check("update_slice", "work_ord_no:i acct_id:i status", """
SELECT w.work_ord_no, w.acct_id,
       CASE WHEN c.c_custkey IS NOT NULL AND w.completion_dt >= DATE '1998-01-01' AND w.status = 'P'
            THEN c.c_mktsegment ELSE w.status END AS status
FROM wo w LEFT JOIN customer c ON c.c_custkey = w.acct_id""")
def _(t):
    recent = (F.col("completion_dt") >= F.lit(date(1998, 1, 1))) & (F.col("status") == "P")
    return change.update_from(
        t["wo"], t["customer"], [("acct_id", "c_custkey")], {"status": "c_mktsegment"}, when=recent
    )


@check("update_constant", "work_ord_no:i status per_end_dt:t",
       "SELECT work_ord_no, status, DATE '1998-08-31' AS per_end_dt FROM wo")
def _(t):
    return t["wo"].withColumn("per_end_dt", F.lit(prev_month_end(AS_OF)))


@check("flag_matched", "work_ord_no svc_no src_cd bcc_migrated_ind", """
SELECT w.work_ord_no, w.svc_no, w.src_cd,
       CASE WHEN w.src_cd = 'ID' AND m.svc_no IS NOT NULL THEN 'Y' ELSE w.bcc_migrated_ind END AS bcc_migrated_ind
FROM two_source w LEFT JOIN
 (SELECT DISTINCT a.svc_no, a.per_end_dt FROM two_source a JOIN two_source b USING (svc_no, per_end_dt)
  WHERE a.src_cd = 'ID' AND b.src_cd = 'ED' AND a.bcc_migrated_ind = 'N') m
  ON m.svc_no = w.svc_no AND m.per_end_dt = w.per_end_dt""")
def _(t):
    return change.flag_matched(t["two_source"], ["svc_no", "per_end_dt"])


@check("case_decode", "work_ord_no:i line_no:i label group_name", """
SELECT work_ord_no, line_no, CASE action WHEN '1' THEN 'Provide' WHEN '2' THEN 'Change' WHEN '3' THEN 'Cancel'
       WHEN '4' THEN 'Cease' ELSE 'NA' END AS label,
       CASE WHEN action IN ('1', '2') THEN 'Gross Adds' ELSE 'Churns' END AS group_name FROM cmp""")
def _(t):
    group = decode_case(F.col("action"), {"1": "Gross Adds", "2": "Gross Adds"}, "Churns")
    return shape.extend(
        t["cmp"], label=decode_case(F.col("action"), PRODUCT_ACTIONS, "NA"), group_name=group
    )


@check("coalesce_dates", "work_ord_no:i end_dt:t",
       "SELECT work_ord_no, COALESCE(inactive_dt, DATE '2899-12-31') AS end_dt FROM cmp")
def _(t):
    return t["cmp"].select("work_ord_no", or_high(F.col("inactive_dt")).alias("end_dt"))


@check("trim_concat", "work_ord_no product:t", """
SELECT bltn_bill_offr_ds AS work_ord_no, TRIM(prod_type_ds) || ' ' || TRIM(subs_type_ds) AS product
FROM ips_f_subs_bltn_base_mnth""")
def _(t):
    return t["ips_f_subs_bltn_base_mnth"].select(
        F.col("bltn_bill_offr_ds").alias("work_ord_no"),
        F.concat(F.trim("prod_type_ds"), F.lit(" "), F.trim("subs_type_ds")).alias("product"),
    )


@check("mid_token", "svc_no code plan_cd:t", """
SELECT svc_no, basic_accs_rate_plan_cd AS code,
       CASE length(basic_accs_rate_plan_cd) - length(replace(basic_accs_rate_plan_cd, '_', ''))
            WHEN 0 THEN basic_accs_rate_plan_cd WHEN 1 THEN NULL
            ELSE string_split(basic_accs_rate_plan_cd, '_')[2] END AS plan_cd
FROM all_daily_add_churn""")
def _(t):
    code = F.col("basic_accs_rate_plan_cd")
    return t["all_daily_add_churn"].select("svc_no", code.alias("code"), mid_token(code).alias("plan_cd"))


@check("position_substring", "code pos:i tail", """
SELECT basic_accs_rate_plan_cd AS code, POSITION('_' IN basic_accs_rate_plan_cd) AS pos,
       SUBSTRING(basic_accs_rate_plan_cd FROM POSITION('_' IN basic_accs_rate_plan_cd) + 1) AS tail
FROM all_daily_add_churn""")
def _(t):
    code = F.col("basic_accs_rate_plan_cd")
    at = F.instr(code, "_")
    return t["all_daily_add_churn"].select(
        code.alias("code"), at.alias("pos"), F.substr(code, at + 1).alias("tail")
    )


@check("casts", "ord_id acct_no plan_cd short done_dt:t done_ts:t", """
SELECT ord_id, CAST(CAST(trunc(acct_id) AS BIGINT) AS VARCHAR) AS acct_no,
       CAST(CAST(trunc(bltn_bill_offr_id) AS BIGINT) AS VARCHAR) AS plan_cd, LEFT(acct_nm, 6) AS short,
       CAST(curr_ord_actn_done_ts AS DATE) AS done_dt,
       CAST(CAST(curr_ord_actn_done_ts AS VARCHAR) AS TIMESTAMP) AS done_ts FROM ips_f_subs_bltn_tran_day""")
def _(t):
    done = F.col("curr_ord_actn_done_ts")
    return t["ips_f_subs_bltn_tran_day"].select(
        "ord_id",
        whole_number_text(F.col("acct_id")).alias("acct_no"),
        whole_number_text(F.col("bltn_bill_offr_id")).alias("plan_cd"),
        varchar(F.col("acct_nm"), 6).alias("short"),
        F.to_date(done).alias("done_dt"),
        done.cast("string").cast("timestamp").alias("done_ts"),
    )


@check("date_parts", "work_ord_no:i y:i m:i d:i next_month:t", """
SELECT work_ord_no, EXTRACT(YEAR FROM completion_dt) AS y, EXTRACT(MONTH FROM completion_dt) AS m,
       EXTRACT(DAY FROM completion_dt) AS d, CAST(completion_dt + INTERVAL 1 MONTH AS DATE) AS next_month FROM wo""")
def _(t):
    day = F.col("completion_dt")
    return t["wo"].select(
        "work_ord_no", F.year(day).alias("y"), F.month(day).alias("m"), F.day(day).alias("d"),
        F.add_months(day, 1).alias("next_month"),
    )


@check("date_arith", "work_ord_no:i before:t after:t gap:t", """
SELECT work_ord_no, active_dt - 15 AS before, active_dt + 5 AS after,
       date_diff('day', active_dt, inactive_dt) AS gap FROM cmp""")
def _(t):
    return t["cmp"].select(
        "work_ord_no", F.date_sub("active_dt", 15).alias("before"), F.date_add("active_dt", 5).alias("after"),
        F.datediff("inactive_dt", "active_dt").alias("gap"),
    )


@check("date_format_month", "acct_no day_text month_text one_month:i", """
SELECT acct_no, strftime(plan_active_dt, '%Y-%m-%d') AS day_text, strftime(plan_active_dt, '%b-%y') AS month_text,
       CASE WHEN date_trunc('month', plan_active_dt) = date_trunc('month', plan_inactive_dt) THEN 1 ELSE 0 END AS one_month
FROM f_tbc_acct_plans""")
def _(t):
    start, end = F.col("plan_active_dt"), F.col("plan_inactive_dt")
    return t["f_tbc_acct_plans"].select(
        "acct_no", iso_text(start).alias("day_text"), month_label(start).alias("month_text"),
        same_month(start, end).cast("int").alias("one_month"),
    )


@check("ci_compare", "work_ord_no action_type", """
SELECT * FROM ott_at_transaction WHERE upper(rtrim(action_type)) IN ('CANCELLATION', 'ORDER', 'DISCONNECTION')""")
def _(t):
    return t["ott_at_transaction"].filter(
        text_in(F.col("action_type"), "cancellation", "ORDER ", "DISCONNECTION")
    )


@check("ts_between_dates", "ord_id done_dt:t", """
SELECT ord_id, CAST(curr_ord_actn_done_ts AS DATE) AS done_dt FROM ips_f_subs_bltn_tran_day
WHERE CAST(curr_ord_actn_done_ts AS DATE) BETWEEN DATE '1998-08-20' AND DATE '1998-08-30'""")
def _(t):
    done = F.col("curr_ord_actn_done_ts")
    return t["ips_f_subs_bltn_tran_day"].filter(on_days(done, *WINDOW)).select(
        "ord_id", F.to_date(done).alias("done_dt")
    )


@check("derive_name_map", "old_name new_name", r"""
SELECT name AS old_name, regexp_replace(name, '(?i)(.)(O)(.*)', '\1P\3') AS new_name FROM
  (SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT 'so' || s_name FROM supplier) n""")
def _(t):
    listed = shape.union_events(
        t["nation"].select(F.col("n_name").alias("name")),
        t["region"].select(F.col("r_name").alias("name")),
        t["supplier"].select(F.concat(F.lit("so"), "s_name").alias("name")),
    )
    return names.derive_name_map(listed, "o", "p")


# A small dictionary of common words; the new words are not themselves entries.
WORDS = {"the": "THE_X", "data": "DATA_X", "and": "AND_X", "de": "DE_X", "la": "LA_X", "in": "IN_X"}


def _listed(spark):
    return spark.createDataFrame(list(WORDS.items()), "old_name string, new_name string")


def _chained(text: str) -> str:
    for old, new in WORDS.items():
        text = rf"regexp_replace({text}, '(?i)\b{old}\b', '{new}', 'g')"
    return text


@check("rewrite_names", "doc_id:i text", f"SELECT doc_id, {_chained('text')} AS text FROM documents")
def _(t):
    docs = t["documents"].select("doc_id", "text")
    return names.rewrite_names(docs, _listed(docs.sparkSession))


@check("name_usage", "doc_id:i name uses:i", " UNION ALL ".join(
    f"SELECT doc_id, '{w}' AS name, len(regexp_extract_all(text, '(?i)\\b{w}\\b')) AS uses FROM documents"
    f" WHERE regexp_matches(text, '(?i)\\b{w}\\b')" for w in WORDS))
def _(t):
    return names.name_usage(t["documents"], _listed(t["documents"].sparkSession))


# A dictionary of thousands of entries: every word of four characters or more in the benchmark texts.
@check("rewrite_names_large", "doc_id:i text", """
SELECT doc_id, string_agg(sep || coalesce(replacement, word, ''), '' ORDER BY i) AS text FROM (
  SELECT doc_id, i, seps[i] AS sep, words[i] AS word FROM (
    SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9_]+') AS words, string_split_regex(text, '[A-Za-z0-9_]+') AS seps
    FROM documents) p, unnest(generate_series(1, len(seps))) s(i)) u
LEFT JOIN (
  SELECT DISTINCT lower(w) AS old, 'x_' || lower(w) AS replacement FROM (
    SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9_]{4,}')) AS w FROM benchmark) b) d ON lower(word) = old
GROUP BY doc_id""")
def _(t):
    words = F.regexp_extract_all("text", F.lit("[A-Za-z0-9_]{4,}"), F.lit(0))
    listed = t["benchmark"].select(F.explode(F.transform(words, F.lower)).alias("old_name")).distinct()
    listed = listed.withColumn("new_name", F.concat(F.lit("x_"), "old_name"))
    return names.rewrite_names(t["documents"].select("doc_id", "text"), listed)
