"""Source-shaped views over the test tables, in SQL that Spark and DuckDB both run.

The business jobs expect order, service and account history; these views derive them from whole test
tables: orders are work orders, line items their components, suppliers plans and components,
customers services (three to an account), events television transactions.
"""

from __future__ import annotations

import re

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

HIGH = "DATE '2899-12-31'"
ACCOUNT = "CAST(FLOOR({} / 3) AS BIGINT)"
CODE = "CASE {0} WHEN 3 THEN 601952 WHEN 6 THEN 602331 ELSE {0} END"
ID_TYPE = "CASE k % 5 WHEN 2 THEN '601' WHEN 3 THEN '15' WHEN 4 THEN '99' ELSE '20' END"

VIEWS: dict[str, str] = {}

VIEWS["cust_hist"] = f"""
SELECT k, open_dt, first_dt, prio,
       COALESCE(LEAD(open_dt) OVER (PARTITION BY k ORDER BY open_dt) - 1, {HIGH}) AS close_dt
FROM (SELECT o_custkey AS k, CAST(date_trunc('year', o_orderdate) AS DATE) AS open_dt,
             MIN(CAST(o_orderdate AS DATE)) AS first_dt, SUBSTR(MIN(o_orderpriority), 1, 1) AS prio
      FROM orders GROUP BY o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE)) y"""

VIEWS["oo_svcins"] = f"""
SELECT CAST(k AS STRING) AS svc_inst_id, CAST({ACCOUNT.format('k')} AS STRING) AS acct_id,
       '1' AS svc_type, CASE WHEN prio <= '3' THEN '1' WHEN prio = '4' THEN '3' ELSE '2' END AS svc_inst_status,
       CAST(k % 30 AS STRING) AS rental_tariff_grp, first_dt AS start_dt,
       CASE WHEN prio = '5' THEN open_dt + 200 END AS end_dt, open_dt, close_dt
FROM cust_hist"""

VIEWS["oo_wrkord"] = """
SELECT CAST(o_orderkey AS STRING) AS work_ord_no, 'X' || CAST(o_orderkey AS STRING) AS ext_ord_ref_no,
       CAST(o_custkey AS STRING) AS svc_inst_id, CAST(o_orderdate AS DATE) AS work_ord_completion_dt,
       '0' || SUBSTR(o_orderpriority, 1, 1) || ':30:00' AS work_ord_completion_tm,
       CAST(o_orderdate AS DATE) - 3 AS work_ord_create_dt, '09:00:00' AS work_ord_create_tm,
       CAST(o_orderdate AS DATE) + 1 AS work_ord_close_dt,
       CASE o_orderstatus WHEN 'P' THEN '3' ELSE '4' END AS work_ord_status,
       CASE SUBSTR(o_orderpriority, 1, 1) WHEN '1' THEN '1' WHEN '5' THEN '3' ELSE '2' END AS work_ord_type,
       'U' || CAST(o_custkey % 9 AS STRING) AS work_ord_create_id,
       CASE WHEN o_totalprice < 20000 THEN NULL WHEN SUBSTR(o_orderpriority, 1, 1) = '4' THEN '40'
            ELSE '1' || SUBSTR(o_orderpriority, 1, 1) END AS svc_action_type,
       'D' || CAST(o_custkey % 7 AS STRING) AS dealer_cd, SUBSTR(o_orderpriority, 1, 1) AS disconnect_cd
FROM orders"""

VIEWS["oo_svciex"] = f"""
SELECT CAST(k AS STRING) AS svc_inst_id, 'S' || CAST(k AS STRING) AS ext_id, {ID_TYPE} AS ext_id_type,
       open_dt - 30 AS start_dt, CASE WHEN prio = '3' THEN open_dt + 300 END AS end_dt, open_dt, close_dt
FROM cust_hist"""

VIEWS["oo_svcijn"] = """
SELECT CAST(k AS STRING) AS svc_inst_id, 'R' || CAST(k % 11 AS STRING) || prio AS rep_id, open_dt, close_dt
FROM cust_hist"""

VIEWS["oo_wrkojn"] = f"""
SELECT CAST(o_orderkey AS STRING) AS work_ord_no, 'R' || CAST(o_custkey % 13 AS STRING) AS reps_id,
       'CH' || SUBSTR(o_orderpriority, 1, 1) AS sales_chanl_id, 'ST' || o_orderstatus AS retl_store,
       'AP' || o_orderstatus AS acq_partnr_cmpny,
       CAST(o_orderdate AS DATE) - 5 AS open_dt, CAST(o_orderdate AS DATE) + 20 AS close_dt
FROM orders WHERE SUBSTR(o_orderpriority, 1, 1) <> '2'
UNION ALL
SELECT CAST(o_orderkey AS STRING), 'Q' || CAST(o_custkey % 13 AS STRING), 'CH0', NULL, NULL,
       CAST(o_orderdate AS DATE), {HIGH}
FROM orders WHERE SUBSTR(o_orderpriority, 1, 1) = '1'"""

VIEWS["oo_btxnpa"] = """
SELECT DISTINCT CAST(l_orderkey AS STRING) AS work_ord_no, 'P' || CAST(l_orderkey AS STRING) AS int_pack_inst,
       1 + l_orderkey % 9 AS package_id
FROM lineitem"""

VIEWS["oo_btxncm"] = """
SELECT 'P' || CAST(l_orderkey AS STRING) AS int_pack_inst, CAST(l_suppkey AS STRING) AS component_id,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '1' WHEN l_returnflag = 'N' THEN '2'
            WHEN l_returnflag = 'A' THEN '3' ELSE '4' END AS bill_product_action,
       CASE WHEN l_discount > 0.09 THEN NULL ELSE CAST(date_trunc('year', l_shipdate) AS DATE) END AS active_dt,
       CASE WHEN l_returnflag <> 'N' OR (l_linestatus = 'F' AND l_discount < 0.02)
            THEN CAST(l_shipdate AS DATE) END AS inactive_dt
FROM lineitem"""

VIEWS["bolton_rp_ref"] = """
SELECT CAST(s_suppkey AS STRING) AS rate_plan_cd, s_name AS rate_plan_ds,
       CASE WHEN s_nationkey % 3 = 0 THEN '0' ELSE '1' END AS bolton_in
FROM supplier"""

VIEWS["oo_reftmc"] = f"""
SELECT '1' || CAST(r_regionkey + 1 AS STRING) AS mstr_cd, 'SVC_ACTION_TY' AS mstr_cd_key_type,
       r_name AS decoded_value, {HIGH} AS close_dt FROM region
UNION ALL SELECT CAST(n_nationkey AS STRING), 'rental_tariff_grp  ', n_name, {HIGH} FROM nation
UNION ALL SELECT CAST(n_nationkey AS STRING), 'Rental_Tariff_Grp', 'old ' || n_name, DATE '1999-01-01' FROM nation
UNION ALL SELECT CAST(r_regionkey + 1 AS STRING), 'DISCONNECT_CD', 'reason ' || r_name, {HIGH} FROM region"""

VIEWS["ar_a100"] = f"""
SELECT CAST(a AS INT) AS account_no, 'Acct ' || CAST(a AS STRING) AS bill_lname,
       CAST(3000 + a % 100 AS STRING) AS bill_zip, CAST(prio AS SMALLINT) AS vip_code,
       'C' || prio AS owning_cost_ctr, 'Centre ' || prio AS owning_cost_ctr_dv, open_dt,
       COALESCE(LEAD(open_dt) OVER (PARTITION BY a ORDER BY open_dt) - 1, {HIGH}) AS close_dt
FROM (SELECT {ACCOUNT.format('k')} AS a, open_dt, MAX(prio) AS prio FROM cust_hist
      GROUP BY {ACCOUNT.format('k')}, open_dt) y"""

VIEWS["ar_a200"] = f"""
SELECT DISTINCT account_no, CAST(account_no AS STRING) AS external_id, '1' AS external_id_type, {HIGH} AS close_dt
FROM ar_a100
UNION ALL SELECT DISTINCT account_no, CAST(account_no + 1 AS STRING), '2', {HIGH} FROM ar_a100
UNION ALL SELECT DISTINCT account_no, CAST(account_no + 1 AS STRING), '1', DATE '1999-01-01' FROM ar_a100"""

VIEWS["ar_s100"] = f"""
SELECT CAST(k AS INT) AS subscr_no, CAST({ACCOUNT.format('k')} AS INT) AS account_no,
       CAST(k % 30 AS INT) AS emf_config_id, CAST({ID_TYPE} AS SMALLINT) AS display_external_id_type,
       CASE WHEN k % 17 = 0 THEN '40' ELSE '1' END AS record_type, CAST(first_dt AS TIMESTAMP) AS service_start,
       CASE WHEN prio = '5' THEN CAST(open_dt + 500 AS TIMESTAMP) END AS service_end, open_dt, close_dt
FROM cust_hist"""

VIEWS["ar_s200"] = f"""
SELECT CAST(k AS INT) AS subscr_no, 'S' || CAST(k AS STRING) AS external_id, {ID_TYPE} AS external_id_type,
       CAST(open_dt - 40 AS TIMESTAMP) AS active_date,
       CASE WHEN prio = '2' THEN CAST(open_dt + 350 AS TIMESTAMP) END AS inactive_date,
       CASE WHEN k % 19 = 0 THEN '40' ELSE '1' END AS record_type, open_dt, close_dt
FROM cust_hist"""

VIEWS["ar_p200"] = f"""
SELECT CAST(o_custkey AS INT) AS subscr_no, CAST({ACCOUNT.format('o_custkey')} AS INT) AS account_no,
       CAST({CODE.format('l_suppkey')} AS INT) AS component_id, CAST(l_linenumber AS INT) AS package_id,
       CAST(l_shipdate AS TIMESTAMP) AS product_start,
       CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_shipdate AS DATE) + 400 AS TIMESTAMP) END AS product_stop,
       CAST(l_shipdate AS TIMESTAMP) AS cce_active_dt,
       CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_shipdate AS DATE) + 400 AS TIMESTAMP) END AS cce_inactive_dt,
       CAST(l_shipdate AS DATE) AS open_dt,
       CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + 500 ELSE {HIGH} END AS close_dt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

VIEWS["ar_package_definition_ref"] = f"""
SELECT CAST(n_nationkey AS INT) AS package_id, CAST(n_nationkey AS INT) AS package_group, {HIGH} AS close_dt
FROM nation"""

VIEWS["ar_package_components"] = f"""
SELECT CAST(s_nationkey AS INT) AS package_id, CAST({CODE.format('s_suppkey')} AS INT) AS component_id,
       {HIGH} AS close_dt
FROM supplier"""

VIEWS["ar_component_definition_values"] = f"""
SELECT CAST({CODE.format('s_suppkey')} AS INT) AS component_id, s_name AS component_id_dv,
       SUBSTR(s_name, 1, 10) AS short_display, {HIGH} AS close_dt
FROM supplier"""

VIEWS["ar_emf_config_id_values"] = f"""
SELECT CAST(n_nationkey AS INT) AS emf_config_id, n_name AS display_value, {HIGH} AS close_dt FROM nation"""

VIEWS["acct"] = f"""
SELECT CAST(c_custkey AS STRING) AS acct_no, 'Name ' || CAST(CAST(FLOOR(c_custkey / 2) AS BIGINT) AS STRING) AS acct_name,
       DATE '2020-01-01' AS open_dt,
       CASE WHEN c_custkey % 10 = 9 THEN DATE '2021-01-01' ELSE {HIGH} END AS close_dt
FROM customer"""

VIEWS["cfg_rate_plan_ref"] = """
SELECT CAST(s_suppkey AS STRING) AS rate_plan_cd, s_name AS rate_plan_ds,
       CASE s_nationkey % 3 WHEN 0 THEN 'Mobile Internet Data Bolt On' WHEN 1 THEN 'BLACKBERRY ' ELSE 'Other' END
         AS prod_grp_lvl_1,
       'G' || CAST(s_nationkey AS STRING) AS prod_grp_lvl_3,
       CASE WHEN s_nationkey < 12 THEN 'TBC bolton' ELSE 'Other' END AS rate_plan_lvl_2,
       'Pacman' AS rate_plan_lvl_3, CASE WHEN s_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END AS commissionable_in,
       '1' AS bb_cnt_in, '1' AS bolton_in
FROM supplier"""

VIEWS["zz_cfg_rate_plan_ref"] = f"""
SELECT CAST({CODE.format('s_suppkey')} AS STRING) AS rate_plan_cd, 'zz ' || s_name AS rate_plan_ds,
       'G' || CAST(s_nationkey AS STRING) AS prod_grp_lvl_3, s_acctbal AS wght_avg_accs_fee
FROM supplier"""

VIEWS["cfg_sov_ref"] = f"""
SELECT 'V' || CAST(s_suppkey AS STRING) AS rate_plan_cd, 'Plan ' || CAST(s_suppkey AS STRING) AS rate_plan_ds,
       CASE WHEN s_nationkey = 7 THEN DATE '2000-01-01' ELSE {HIGH} END AS end_dt
FROM supplier"""

VIEWS["cfg_sales_class_ref"] = """
SELECT CAST(r_regionkey + 1 AS STRING) AS sales_class_ref_cd,
       CASE r_regionkey WHEN 0 THEN 'SMB' WHEN 1 THEN 'Consumer' ELSE 'Class ' || r_name END AS cfu
FROM region WHERE r_regionkey < 4"""

VIEWS["md_sales_class_ref"] = f"SELECT sales_class_ref_cd, cfu, {HIGH} AS close_dt FROM cfg_sales_class_ref"

VIEWS["l_service_event"] = """
SELECT CASE r_regionkey WHEN 0 THEN 'A' WHEN 1 THEN 'R' WHEN 2 THEN 'N' ELSE 'Z' || r_name END AS service_event_cd,
       CASE r_regionkey WHEN 0 THEN 'Gross Adds' WHEN 1 THEN 'Churns' ELSE 'Other' END AS service_event_grp
FROM region"""

VIEWS["ott_at_transaction"] = """
SELECT CASE event_type WHEN 'purchase' THEN 'ACTIVATION' WHEN 'error' THEN 'Disconnection' WHEN 'click' THEN 'Order'
            WHEN 'view' THEN 'CANCELLATION ' ELSE 'Other' END AS action_type,
       CAST(user_id AS STRING) AS service_id, CAST(user_id AS STRING) AS account_number,
       CASE WHEN user_id % 2 = 0 THEN 'ONC' ELSE 'OTH' END AS service_type,
       'M' || CAST(user_id % 5 AS STRING) AS cmbs_rate_plan_id, 'O' || CAST(user_id % 7 AS STRING) AS opom_component_id,
       'PC' || CAST(user_id % 4 AS STRING) AS product_code,
       CASE user_id % 3 WHEN 0 THEN 'A_B' || CAST(user_id AS STRING) || '_C' WHEN 1 THEN 'PLAIN' ELSE 'A_B' END
         AS sys_rate_plan_cd,
       'system plan' AS sys_rate_plan_nm,
       CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'plan ' || CAST(user_id % 6 AS STRING) END AS plan_name,
       'Consumer' AS cfu, CAST(2000 + user_id AS STRING) AS addr_post_cd, 'W' || CAST(event_id AS STRING) AS work_ord_no,
       'O' || CAST(event_id AS STRING) AS sos_order_no, 'CH' || CAST(user_id % 3 AS STRING) AS opom_sales_chanl_id,
       regexp_extract(props, '[0-9]+', 0) AS dealer_id, 'R' || CAST(event_id % 50 AS STRING) AS rep_id,
       CAST(ts AS DATE) AS transaction_date
FROM events"""

VIEWS["all_daily_add_churn"] = f"""
SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 'C' ELSE l_returnflag END AS svc_stat_cd,
       'S' || CAST(l_orderkey AS STRING) AS svc_no, CAST({ACCOUNT.format('l_orderkey')} AS STRING) AS acct_no,
       'Bill ' || CAST(l_orderkey AS STRING) AS bill_to_acct_nm, 'Plan ' || CAST(l_suppkey AS STRING) AS contrct_nm,
       CASE WHEN l_linenumber <= 2 THEN CAST(l_partkey % 200 AS STRING)
            WHEN l_partkey % 3 = 0 THEN 'X_' || CAST(l_suppkey AS STRING) || '_Y'
            WHEN l_partkey % 3 = 1 THEN CAST(l_suppkey AS STRING) ELSE 'X_Y' END AS basic_accs_rate_plan_cd,
       CAST(l_suppkey AS STRING) AS bolton_rate_plan_cd,
       CASE WHEN l_quantity < 20 THEN 'SMB' WHEN l_quantity < 40 THEN 'Consumer' ELSE 'Corp' END AS cfu,
       'R' || CAST(l_partkey % 21 AS STRING) AS rep_cd, 'D' || CAST(l_suppkey % 8 AS STRING) AS dlr_cd,
       CAST(3000 + l_partkey % 50 AS STRING) AS cust_post_cd, 'F' || CAST(l_orderkey AS STRING) AS ref_no,
       l_linestatus AS rsn_cd,
       CASE l_linenumber WHEN 1 THEN 'fixed_fbb_adds_stg' WHEN 2 THEN 'fixed_fbb_canx_stg' WHEN 3 THEN 'mob_mobile_data'
            WHEN 4 THEN 'mob_mobile_data' WHEN 5 THEN 'mob_blackberry' WHEN 6 THEN 'mob_blackberry' ELSE 'other' END
         AS src_tbl,
       CAST(l_shipdate AS DATE) AS day_dt, CAST(l_linenumber AS INT) AS no_of_svc_x_acct
FROM lineitem"""

VIEWS["oo_awkord"] = f"""
SELECT CAST(o_orderkey AS STRING) AS work_ord_no, CAST({ACCOUNT.format('o_custkey')} AS STRING) AS acct_id,
       'D' || CAST(o_custkey % 7 AS STRING) AS dealer_cd, CAST(o_orderdate AS DATE) - 3 AS work_ord_create_dt,
       CAST(o_orderdate AS DATE) AS work_ord_completion_dt, '10:00:00' AS work_ord_completion_tm,
       CASE o_orderstatus WHEN 'P' THEN '3' ELSE '4' END AS work_ord_status, 'U1' AS work_ord_create_id,
       '1' AS work_ord_type
FROM orders"""

VIEWS["f_tbc_acct_plans"] = f"""
SELECT CAST({ACCOUNT.format('o_custkey')} AS STRING) AS acct_no,
       CASE SUBSTR(o_orderpriority, 1, 1) WHEN '1' THEN 'Voice Plan' WHEN '2' THEN 'Voice Plan' WHEN '3' THEN 'Data Plan'
            ELSE 'Other' END AS plan_type,
       'Bill ' || CAST(o_custkey AS STRING) AS bill_to_nm, CAST(3000 + o_custkey % 60 AS STRING) AS post_cd,
       'Plan ' || CAST(o_orderkey AS STRING) AS plan_component_desc, CAST(o_orderkey AS INT) AS plan_component_id,
       CAST(o_orderdate AS DATE) AS plan_active_dt,
       CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS DATE) + 10 WHEN 'P' THEN CAST(o_orderdate AS DATE) + 400
            ELSE {HIGH} END AS plan_inactive_dt
FROM orders"""

VIEWS["ips_f_subs_bltn_tran_day"] = """
SELECT CASE l_returnflag WHEN 'A' THEN 'Gross Adds' WHEN 'R' THEN 'Churns' ELSE 'Changes' END AS evnt_type_ds,
       'S' || CAST(l_partkey AS STRING) AS prim_rsrc_valu_txt, CAST(l_orderkey AS DOUBLE) + 0.75 AS acct_id,
       'Name ' || CAST(l_orderkey AS STRING) AS acct_nm, CAST(l_suppkey AS DOUBLE) + 0.5 AS bltn_bill_offr_id,
       'Offer ' || CAST(l_suppkey AS STRING) AS bltn_bill_offr_ds, CAST(l_partkey AS DOUBLE) AS main_bill_offr_id,
       'Main ' || CAST(l_partkey AS STRING) AS main_bill_offr_ds,
       CASE l_linenumber WHEN 1 THEN ' D ' WHEN 2 THEN 'S' WHEN 3 THEN 'd' WHEN 4 THEN NULL ELSE 'X' END AS acct_type_cd,
       l_linestatus AS acct_type_ds, 'type ' || l_returnflag AS appl_cust_type_ds, 'agent' AS curr_agnt_lgin_nm,
       'D' || CAST(l_suppkey AS STRING) AS curr_deal_id, CAST(l_partkey % 90 AS STRING) AS acct_zip_cd,
       CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ord_id, CAST(l_partkey AS DOUBLE) AS subs_id,
       CAST(l_shipdate AS TIMESTAMP) AS assg_prce_plan_strt_ts,
       CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS TIMESTAMP) END AS assg_prce_plan_end_ts,
       l_shipdate + INTERVAL '23' HOUR AS curr_ord_actn_done_ts,
       CAST(l_shipdate AS TIMESTAMP) AS curr_ord_actn_strt_ts, l_returnflag AS curr_ord_actn_type_id,
       'act ' || l_returnflag AS curr_ord_actn_type_ds, 'CH' AS curr_sale_serv_chnl_refr_id, 'rsn' AS curr_ord_actn_rsn_ds,
       'r1' AS curr_ord_actn_rsn_id, 'D1' AS prov_deal_id, 'prov' AS prov_agnt_lgin_nm,
       CAST(l_linenumber AS INT) AS acct_mkt_sgmt_serv_cnt, CAST(l_shipdate AS TIMESTAMP) AS run_ts
FROM lineitem"""

VIEWS["ips_f_subs_bltn_base_mnth"] = """
SELECT CAST(o_orderdate AS DATE) AS perd_end_dt, 'S' || CAST(o_custkey AS STRING) AS prim_rsrc_valu_txt,
       ' Mobile ' AS prod_type_ds, o_orderstatus || ' ' AS subs_type_ds, CAST(o_orderdate AS TIMESTAMP) AS orig_actv_ts,
       CAST(o_orderdate AS TIMESTAMP) AS assg_prce_plan_strt_ts, CAST(o_orderkey AS DOUBLE) + 0.5 AS bltn_bill_offr_id,
       'Offer ' || CAST(o_orderkey AS STRING) AS bltn_bill_offr_ds, CAST(o_custkey AS DOUBLE) AS main_bill_offr_id,
       'Main ' || CAST(o_custkey AS STRING) AS main_bill_offr_ds, CAST(o_custkey AS DOUBLE) + 0.9 AS acct_id,
       'Name ' || CAST(o_custkey AS STRING) AS acct_nm, '3000' AS acct_zip_cd, CAST(o_custkey % 9 AS INT) AS acct_mkt_sgmt_serv_cnt,
       CASE SUBSTR(o_orderpriority, 1, 1) WHEN '1' THEN 'D' WHEN '2' THEN ' S' ELSE 'Q' END AS acct_type_cd,
       o_orderpriority AS acct_type_ds, 'D' || CAST(o_custkey % 5 AS STRING) AS prov_deal_id, 'agent' AS prov_agnt_lgin_nm,
       'CH' AS prov_sale_serv_chnl_nm
FROM orders"""

VIEWS["two_source"] = """
SELECT CAST(o_orderkey AS STRING) AS work_ord_no, 'S' || CAST(o_custkey AS STRING) AS svc_no,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS work_ord_completion_dt,
       last_day(CAST(o_orderdate AS DATE)) AS per_end_dt,
       CASE WHEN o_orderkey % 2 = 1 THEN 'ID' ELSE 'ED' END AS src_cd,
       CASE WHEN o_totalprice > 400000 THEN 'X' ELSE 'N' END AS bcc_migrated_ind
FROM orders"""

VIEWS["f_mob_rev"] = """
SELECT CAST(YEAR(l_shipdate) AS INT) AS bill_yr_no, CAST(MONTH(l_shipdate) AS INT) AS bill_mnth_no,
       'S' || CAST(l_partkey AS STRING) AS svc_no, CAST(l_extendedprice AS DECIMAL(18, 2)) AS net_amt,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE 'G' || CAST(l_linenumber AS STRING) END AS sap_gl,
       CASE WHEN l_tax > 0.07 THEN NULL ELSE l_returnflag END AS sap_prod_cd, l_linestatus AS bill_stmt_chrg_cd
FROM lineitem"""

VIEWS["cfg_rev_ref"] = """
SELECT DISTINCT sap_gl, sap_prod_cd, bill_stmt_chrg_cd,
       CASE sap_gl WHEN 'G3' THEN 'Equipment' WHEN 'G5' THEN NULL ELSE 'Service' END AS chrg_type_lvl_3
FROM f_mob_rev"""

VIEWS["f_mob_mobilebase"] = """
SELECT DISTINCT last_day(CAST(l_shipdate AS DATE)) AS per_end_dt, 'S' || CAST(l_partkey AS STRING) AS service_no,
       'D' || CAST(l_partkey % 40 AS STRING) AS dlr_cd, CAST(l_partkey AS STRING) AS acct_no, '1' AS accs_meth_id,
       CAST(l_partkey % 120 AS STRING) AS rate_plan_cd, 'Bill ' || CAST(l_partkey AS STRING) AS bill_to_nm, 'SMB' AS cfu
FROM lineitem"""

VIEWS["md_dlr_hier_ref"] = f"""
SELECT 'D' || CAST(s_suppkey AS STRING) AS dlr_cd,
       CASE s_nationkey % 3 WHEN 0 THEN 'Business Partners' WHEN 1 THEN 'Direct' ELSE 'Retail' END AS regn,
       CASE WHEN s_nationkey < 20 THEN 'Business Channels' ELSE 'Other' END AS report_grp_cd,
       DATE '1990-01-01' AS dlr_hier_ref_eff_dt,
       CASE WHEN s_nationkey = 4 THEN DATE '1997-01-01' ELSE {HIGH} END AS dlr_hier_ref_end_dt, {HIGH} AS close_dt
FROM supplier"""

# Shapes for the single-operator checks.
VIEWS["wo"] = """
SELECT o_orderkey AS work_ord_no, o_custkey AS acct_id, CAST(o_orderdate AS DATE) AS completion_dt,
       o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price
FROM orders"""

VIEWS["cmp"] = """
SELECT l_orderkey AS work_ord_no, l_partkey AS component_id, l_linenumber AS line_no,
       CAST(l_shipdate AS DATE) AS active_dt,
       CASE l_returnflag WHEN 'N' THEN '1' WHEN 'A' THEN '2' ELSE '3' END AS action,
       CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS inactive_dt
FROM lineitem"""

VIEWS["acct_hist"] = f"""
SELECT acct_id, open_dt, vip_code,
       COALESCE(LEAD(open_dt) OVER (PARTITION BY acct_id ORDER BY open_dt) - 1, {HIGH}) AS close_dt
FROM (SELECT o_custkey AS acct_id, CAST(o_orderdate AS DATE) AS open_dt, MIN(o_orderpriority) AS vip_code
      FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)) d"""


# Intermediate answers of the SQL side only; the Spark side never reads them.
ANSWERS: dict[str, str] = {}


# Views that group, join or order whole tables; the others are made row by row, where they are read.
GATHERED = (
    "cust_hist", "oo_btxnpa", "ar_a100", "ar_a200", "ar_p200", "cfg_rev_ref", "f_mob_mobilebase", "acct_hist",
)

# The same rows for Spark with fewer columns in the shuffle: what depends on a distinct key is made of it afterwards.
NARROW: dict[str, str] = {}

NARROW["oo_btxnpa"] = """
SELECT CAST(l_orderkey AS STRING) AS work_ord_no, 'P' || CAST(l_orderkey AS STRING) AS int_pack_inst,
       1 + l_orderkey % 9 AS package_id
FROM (SELECT DISTINCT l_orderkey FROM lineitem) k"""

NARROW["f_mob_mobilebase"] = """
SELECT per_end_dt, 'S' || CAST(l_partkey AS STRING) AS service_no,
       'D' || CAST(l_partkey % 40 AS STRING) AS dlr_cd, CAST(l_partkey AS STRING) AS acct_no, '1' AS accs_meth_id,
       CAST(l_partkey % 120 AS STRING) AS rate_plan_cd, 'Bill ' || CAST(l_partkey AS STRING) AS bill_to_nm, 'SMB' AS cfu
FROM (SELECT DISTINCT last_day(CAST(l_shipdate AS DATE)) AS per_end_dt, l_partkey FROM lineitem) k"""


def needed(sql: str) -> dict[str, str]:
    """Views and answers a statement uses, directly or through others, in defining order."""
    known = VIEWS | ANSWERS
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        fresh = [v for v in known if v in words and v not in found]
        found.update(fresh)
        todo.extend(known[v] for v in fresh)
    return {v: known[v] for v in known if v in found}
