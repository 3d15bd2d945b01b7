"""DuckDB twins of the queries in ``__spark_entry__.queries()``.

Each query's SQL is assembled from named common table expressions: ``r_*``
are the raw extracts of ``tiers.sources.driver_tables`` and ``s_*`` the
silver tables of ``tiers.plans.specs``, written independently in DuckDB's
dialect. Views ``region nation customer ... conversations`` are registered
by the caller.

Dialect notes: DuckDB has no ``initcap``, so it is spelled out per word;
``regexp_replace`` needs the ``'g'`` flag to replace every match;
``try_strptime`` is the lenient date parse; Spark's ``ASC`` puts NULLs
first, so every ordering says ``NULLS FIRST``.
"""

from __future__ import annotations


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(left(w, 1)) || lower(substring(w, 2))), ' ')")


def first_per_key(src: str, keys: list[str], order: list[str]) -> str:
    part = ", ".join(keys)
    ob = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {part} ORDER BY {ob}) AS __rn FROM {src}) WHERE __rn = 1")


AW = "CAST(c_custkey + 10000000 AS VARCHAR)"
DAY = "(DATE '2020-01-01' + CAST(floor(c_acctbal + 1000) AS INTEGER))"
BORN = "(DATE '1940-01-01' + CAST(floor((c_acctbal + 1000) * 2) AS INTEGER))"
BRAND = "lpad(split_part(p_brand, '#', 2), 2, '0')"

CTE: dict[str, tuple[tuple[str, ...], str]] = {}

CTE["r_crm_cust_info"] = ((), f"""
SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0 THEN NULL ELSE c_custkey END AS cst_id,
       'AW' || {AW} AS cst_key,
       ' ' || lower(c_mktsegment) || ' ' AS cst_firstname,
       lower(replace(c_name, '#', ' ')) AS cst_lastname,
       CASE c_mktsegment WHEN 'BUILDING' THEN ' s ' WHEN 'MACHINERY' THEN 'M'
            WHEN 'AUTOMOBILE' THEN 'married' WHEN 'FURNITURE' THEN 'widowed' END AS cst_marital_status,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_nationkey < 10 THEN ' male'
            WHEN c_nationkey < 20 THEN 'Female' ELSE '  ' END AS cst_gndr,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN strftime({DAY}, '%Y-%m-%d')
            ELSE strftime({DAY}, '%m/%d/%Y') END AS cst_create_date
FROM customer
UNION ALL
SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN 'AW' ELSE 'AX' END || {AW}, c_mktsegment,
       'resent', 'S', 'F', strftime({DAY} + 1, '%m/%d/%Y')
FROM customer WHERE c_acctbal > 9000""")

CTE["r_crm_prd_info"] = ((), f"""
SELECT CASE WHEN p_size = 1 THEN NULL ELSE p_partkey END AS prd_id,
       cat || '-' || pkey AS prd_key,
       ' ' || p_name AS prd_nm,
       lower(substring(p_type, 1, 1)) || ' ' AS prd_line,
       CASE WHEN p_size = 2 THEN 'n/a' WHEN p_size = 3 THEN NULL WHEN p_size = 4 THEN '123456789.00'
            ELSE cost END AS prd_cost
FROM (SELECT *, upper(substring(p_type, 1, 2)) || '-' || {BRAND} AS cat,
             'P' || CAST(p_partkey AS VARCHAR) AS pkey,
             CAST(CAST(floor(p_retailprice * 1000 / 3) AS BIGINT) // 1000 AS VARCHAR) || '.' ||
             lpad(CAST(CAST(floor(p_retailprice * 1000 / 3) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS cost
      FROM part)
UNION ALL
SELECT p_partkey, 'XX-99-P' || CAST(p_partkey AS VARCHAR), p_name, 'X',
       CAST(CAST(floor(p_retailprice * 1000 / 3) AS BIGINT) // 1000 AS VARCHAR) || '.' ||
       lpad(CAST(CAST(floor(p_retailprice * 1000 / 3) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
FROM part WHERE p_size >= 49""")

CTE["r_crm_sales_details"] = ((), """
SELECT 'SO' || CAST(l_orderkey AS VARCHAR) AS sls_ord_num,
       CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN NULL
            ELSE 'P' || CAST(l_partkey AS VARCHAR) END AS sls_prd_key,
       o_custkey AS sls_cust_id,
       CAST(CASE WHEN l_linenumber = 6 THEN 0
                 ELSE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS INTEGER) AS sls_order_dt,
       CASE WHEN l_linestatus = 'O' AND l_linenumber = 5 THEN '5489'
            ELSE strftime(l_shipdate, '%Y%m%d') END AS sls_ship_dt,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN year(l_shipdate) * 10000 + 1332
                 ELSE CAST(strftime(CAST(l_shipdate AS DATE) + 30, '%Y%m%d') AS INTEGER) END AS INTEGER)
            AS sls_due_dt,
       CASE WHEN l_returnflag = 'A' THEN '$' || format('{:,}', cents // 100) || '.' ||
                 lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
            WHEN l_returnflag = 'N' THEN amount
            WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 2 THEN 'n/a'
            ELSE amount END AS sls_sales,
       CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN 'x'
            ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS sls_quantity,
       CASE WHEN l_discount = 0 THEN '-' || unit ELSE unit END AS sls_price
FROM (SELECT *, CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS amount,
             CAST(ucents // 100 AS VARCHAR) || '.' || lpad(CAST(ucents % 100 AS VARCHAR), 2, '0') AS unit
      FROM (SELECT *, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents,
                   CAST(floor(l_extendedprice * 100 / l_quantity + 0.5) AS BIGINT) AS ucents
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey))""")

CTE["r_erp_cust_az12"] = ((), f"""
SELECT CASE WHEN c_nationkey = 3 THEN '' ELSE 'NAS' END || 'AW' || {AW} AS CID,
       CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN '0'
            ELSE strftime({BORN}, '%Y-%m-%d') END AS BDATE,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Male' WHEN 'MACHINERY' THEN 'F'
            WHEN 'AUTOMOBILE' THEN ' female' WHEN 'FURNITURE' THEN '' END AS GEN
FROM customer
UNION ALL
SELECT 'XXXAW' || {AW}, '1980-01-01', 'M' FROM customer WHERE c_acctbal > 9500""")

CTE["r_erp_loc_a101"] = ((), f"""
SELECT 'AW-' || {AW} AS CID,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN '  '
            ELSE ' ' || lower(n_name) END AS CNTRY
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT 'AW' || {AW}, n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9500""")

CTE["r_erp_px_cat_g1v2"] = ((), f"""
SELECT CASE WHEN p_type = 'PROMO' THEN 'PM' ELSE upper(substring(p_type, 1, 2)) END || '_' || brand AS ID,
       ' ' || lower(p_type) AS CAT,
       'brand ' || brand || ' ' AS SUBCAT,
       CASE WHEN CAST(brand AS INTEGER) <= 3 THEN 'yes' WHEN CAST(brand AS INTEGER) <= 6 THEN ' 0'
            WHEN CAST(brand AS INTEGER) <= 9 THEN 'req' WHEN CAST(brand AS INTEGER) <= 12 THEN 'n'
            WHEN CAST(brand AS INTEGER) <= 15 THEN 'None' WHEN CAST(brand AS INTEGER) <= 18 THEN NULL
            WHEN CAST(brand AS INTEGER) <= 21 THEN 'sometimes' ELSE 'False' END AS MAINTENANCE
FROM (SELECT DISTINCT p_type, {BRAND} AS brand FROM part)
UNION ALL
SELECT 'SM-' || brand, 'small parts', brand, 'Y'
FROM (SELECT DISTINCT p_type, {BRAND} AS brand FROM part) WHERE p_type = 'SMALL'""")

# ---- silver ------------------------------------------------------------

CUST_ORDER = ["cst_id", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr",
              "cst_create_date"]
CTE["d_crm_cust_info"] = (("r_crm_cust_info",), first_per_key(
    "(SELECT * FROM r_crm_cust_info WHERE cst_id IS NOT NULL AND cst_key IS NOT NULL)",
    ["cst_key"], CUST_ORDER))
CTE["s_crm_cust_info"] = (("d_crm_cust_info",), f"""
SELECT cst_id, cst_key,
       {initcap('trim(cst_firstname)')} AS cst_firstname,
       {initcap('trim(cst_lastname)')} AS cst_lastname,
       CASE WHEN starts_with(lower(trim(cst_marital_status)), 's') THEN 'Single'
            WHEN starts_with(lower(trim(cst_marital_status)), 'm') THEN 'Married'
            ELSE 'Unknown' END AS cst_marital_status,
       CASE WHEN cst_gndr IS NOT NULL THEN upper(substring(trim(cst_gndr), 1, 1))
            ELSE 'Unknown' END AS cst_gndr,
       CAST(try_strptime(cst_create_date, '%m/%d/%Y') AS DATE) AS cst_create_date
FROM d_crm_cust_info""")

CTE["d_prd_info"] = (("r_crm_prd_info",), first_per_key(
    "(SELECT * FROM r_crm_prd_info WHERE prd_id IS NOT NULL AND prd_key IS NOT NULL)",
    ["prd_key"], ["prd_id", "prd_nm", "prd_line", "prd_cost"]))
CTE["s_prd_info"] = (("d_prd_info",), f"""
SELECT substring(prd_key, 7, length(prd_key)) AS prd_id, prd_key,
       {initcap('trim(prd_nm)')} AS prd_nm,
       upper(trim(prd_line)) AS prd_line,
       TRY_CAST(prd_cost AS DECIMAL(10,2)) AS prd_cost,
       substring(prd_key, 1, 5) AS cat_id
FROM d_prd_info""")


def _ymd(c: str) -> str:
    return f"CAST(try_strptime(CAST({c} AS VARCHAR), '%Y%m%d') AS DATE)"


def _money(c: str) -> str:
    return f"TRY_CAST(regexp_replace(CAST({c} AS VARCHAR), '[$,]', '', 'g') AS DECIMAL(10,2))"


CTE["d_sales_details"] = (("r_crm_sales_details",), first_per_key(
    "(SELECT * FROM r_crm_sales_details WHERE sls_ord_num IS NOT NULL AND sls_prd_key IS NOT NULL "
    "AND sls_cust_id IS NOT NULL)",
    ["sls_ord_num", "sls_prd_key"],
    ["sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity",
     "sls_price"]))
CTE["s_sales_details"] = (("d_sales_details",), f"""
SELECT sls_ord_num, sls_prd_key, sls_cust_id,
       {_ymd('sls_order_dt')} AS sls_order_dt,
       {_ymd('sls_ship_dt')} AS sls_ship_dt,
       {_ymd('sls_due_dt')} AS sls_due_dt,
       {_money('sls_sales')} AS sls_sales,
       TRY_CAST(sls_quantity AS INTEGER) AS sls_quantity,
       {_money('sls_price')} AS sls_price
FROM d_sales_details""")

CTE["d_erp_cust_az12"] = (("r_erp_cust_az12",), first_per_key(
    "(SELECT * FROM r_erp_cust_az12 WHERE CID IS NOT NULL)", ["CID"], ["BDATE", "GEN"]))
CTE["s_erp_cust_az12"] = (("d_erp_cust_az12",), """
SELECT substring(CID, 4, length(CID)) AS CID,
       CAST(try_strptime(CAST(BDATE AS VARCHAR), '%Y-%m-%d') AS DATE) AS BDATE,
       upper(substring(trim(GEN), 1, 1)) AS GEN
FROM d_erp_cust_az12""")

CTE["d_loc_a101"] = (("r_erp_loc_a101",), first_per_key(
    "(SELECT * FROM r_erp_loc_a101 WHERE CID IS NOT NULL)", ["CID"], ["CNTRY"]))
CTE["s_loc_a101"] = (("d_loc_a101",), """
SELECT regexp_replace(CID, '-', '', 'g') AS CID,
       coalesce(upper(trim(CNTRY)), 'UNKNOWN') AS CNTRY
FROM d_loc_a101""")

CTE["d_erp_px_cat_g1v2"] = (("r_erp_px_cat_g1v2",), first_per_key(
    "(SELECT * FROM r_erp_px_cat_g1v2 WHERE ID IS NOT NULL)", ["ID"], ["CAT", "SUBCAT", "MAINTENANCE"]))
CTE["s_erp_px_cat_g1v2"] = (("d_erp_px_cat_g1v2",), """
SELECT regexp_replace(ID, '_', '-', 'g') AS ID,
       upper(trim(CAT)) AS CAT,
       upper(trim(SUBCAT)) AS SUBCAT,
       coalesce(CASE WHEN upper(trim(MAINTENANCE)) IN ('Y', '1', 'TRUE', 'YES', 'REQ') THEN 'YES'
                     WHEN upper(trim(MAINTENANCE)) IN ('N', '0', 'FALSE', 'NO', 'NONE') THEN 'NO'
                     ELSE upper(trim(MAINTENANCE)) END, 'UNKNOWN') AS MAINTENANCE
FROM d_erp_px_cat_g1v2""")

# ---- gold --------------------------------------------------------------

CTE["g_dim_customer"] = (("s_crm_cust_info", "s_erp_cust_az12", "s_loc_a101"), """
SELECT c.cst_id AS customer_id, c.cst_firstname AS first_name, c.cst_lastname AS last_name,
       c.cst_marital_status AS marital_status, c.cst_gndr AS crm_gender, a.GEN AS erp_gender,
       a.BDATE AS birth_date, l.CNTRY AS country
FROM s_crm_cust_info c
LEFT JOIN s_erp_cust_az12 a ON c.cst_key = a.CID
LEFT JOIN s_loc_a101 l ON c.cst_key = l.CID""")

CTE["g_dim_product"] = (("s_prd_info", "s_erp_px_cat_g1v2"), """
SELECT p.prd_key AS product_key, p.prd_nm AS product_name, p.prd_cost AS cost, p.prd_line AS line,
       p.cat_id AS category_id, k.CAT AS category_name, k.SUBCAT AS subcategory_name
FROM s_prd_info p LEFT JOIN s_erp_px_cat_g1v2 k ON p.cat_id = k.ID""")

CTE["g_fact_sales"] = (("s_sales_details", "s_prd_info", "s_crm_cust_info"), """
SELECT s.sls_ord_num AS order_number, s.sls_prd_key AS product_key, s.sls_cust_id AS customer_id,
       s.sls_order_dt AS order_date, s.sls_sales AS sales_amount, s.sls_quantity AS quantity,
       s.sls_price AS price
FROM s_sales_details s
LEFT JOIN s_prd_info p ON s.sls_prd_key = p.prd_id
LEFT JOIN s_crm_cust_info c ON s.sls_cust_id = c.cst_id""")


def with_ctes(body: str, *names: str) -> str:
    """``WITH`` the named CTEs (and their inputs, in dependency order) + body."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTE[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({CTE[n][1].strip()})" for n in order)
    return f"WITH {parts}\n{body.strip()}"


SQL: dict[str, str] = {}


def q(name: str, body: str, *ctes: str) -> None:
    SQL[name] = with_ctes(body, *ctes)


q("fact_sales", "SELECT * FROM g_fact_sales", "g_fact_sales")
q("dim_customer", "SELECT * FROM g_dim_customer", "g_dim_customer")
q("dim_product", "SELECT * FROM g_dim_product", "g_dim_product")
for _t in ("crm_cust_info", "prd_info", "sales_details", "erp_cust_az12", "loc_a101", "erp_px_cat_g1v2"):
    q(f"silver_{_t}", f"SELECT * FROM s_{_t}", f"s_{_t}")

# ---- more gold / silver variants ---------------------------------------

q("dim_customer_unique", f"""
SELECT c.cst_id AS customer_id, c.cst_firstname AS first_name, c.cst_lastname AS last_name,
       c.cst_marital_status AS marital_status, c.cst_gndr AS crm_gender, a.GEN AS erp_gender,
       a.BDATE AS birth_date, l.CNTRY AS country
FROM s_crm_cust_info c
LEFT JOIN ({first_per_key('s_erp_cust_az12', ['CID'], ['GEN', 'BDATE'])}) a ON c.cst_key = a.CID
LEFT JOIN ({first_per_key('s_loc_a101', ['CID'], ['CNTRY'])}) l ON c.cst_key = l.CID""",
  "s_crm_cust_info", "s_erp_cust_az12", "s_loc_a101")

q("dim_product_code", """
SELECT p.prd_key AS product_key, p.prd_nm AS product_name, p.prd_cost AS cost, p.prd_line AS line,
       p.cat_id AS category_id, k.CAT AS category_name, k.SUBCAT AS subcategory_name,
       p.prd_id AS product_code
FROM s_prd_info p LEFT JOIN s_erp_px_cat_g1v2 k ON p.cat_id = k.ID""", "s_prd_info", "s_erp_px_cat_g1v2")

q("silver_loc_a101_unique", first_per_key(
    "(SELECT regexp_replace(CID, '-', '', 'g') AS CID, coalesce(upper(trim(CNTRY)), 'UNKNOWN') AS CNTRY "
    "FROM r_erp_loc_a101 WHERE CID IS NOT NULL)", ["CID"], ["CNTRY"]), "r_erp_loc_a101")

# ---- column rules --------------------------------------------------------

q("title_code", f"""
SELECT cst_key, {initcap('trim(cst_firstname)')} AS first_name, {initcap('trim(cst_lastname)')} AS last_name,
       trim(cst_firstname) AS first_trimmed, upper(trim(cst_marital_status)) AS marital_code,
       lower(trim(cst_gndr)) AS gender_folded
FROM r_crm_cust_info""", "r_crm_cust_info")

q("initial", """
SELECT CID, GEN, upper(substring(trim(GEN), 1, 1)) AS gen_letter,
       CASE WHEN GEN IS NOT NULL THEN upper(substring(trim(GEN), 1, 1)) ELSE 'Unknown' END AS gen_or_unknown
FROM r_erp_cust_az12""", "r_erp_cust_az12")

q("by_prefix", """
SELECT cst_key, cst_marital_status,
       CASE WHEN starts_with(lower(trim(cst_marital_status)), 's') THEN 'Single'
            WHEN starts_with(lower(trim(cst_marital_status)), 'm') THEN 'Married'
            ELSE 'Unknown' END AS marital_status
FROM r_crm_cust_info""", "r_crm_cust_info")

q("by_value", """
SELECT ID, MAINTENANCE,
       CASE WHEN upper(trim(MAINTENANCE)) IN ('Y', '1', 'TRUE', 'YES', 'REQ') THEN 'YES'
            WHEN upper(trim(MAINTENANCE)) IN ('N', '0', 'FALSE', 'NO', 'NONE') THEN 'NO'
            ELSE upper(trim(MAINTENANCE)) END AS maintenance_flag
FROM r_erp_px_cat_g1v2""", "r_erp_px_cat_g1v2")

q("default_fill", "SELECT CID, coalesce(upper(trim(CNTRY)), 'UNKNOWN') AS CNTRY FROM r_erp_loc_a101",
  "r_erp_loc_a101")

q("key_split", """
SELECT prd_key, substring(prd_key, 1, 5) AS cat_id, substring(prd_key, 7, length(prd_key)) AS product_code
FROM r_crm_prd_info""", "r_crm_prd_info")

q("strip_prefix", """
SELECT CID, substring(CID, 4, length(CID)) AS cid_cut,
       CASE WHEN starts_with(CID, 'NAS') THEN substring(CID, 4, length(CID)) ELSE CID END AS cid_checked
FROM r_erp_cust_az12""", "r_erp_cust_az12")

q("key_remove", "SELECT CID, regexp_replace(CID, '-', '', 'g') AS cid_clean FROM r_erp_loc_a101",
  "r_erp_loc_a101")
q("key_replace", "SELECT ID, regexp_replace(ID, '_', '-', 'g') AS id_clean FROM r_erp_px_cat_g1v2",
  "r_erp_px_cat_g1v2")

q("money", f"""
SELECT sls_ord_num, sls_prd_key, sls_sales, sls_price, {_money('sls_sales')} AS sales_amount,
       {_money('sls_price')} AS price
FROM r_crm_sales_details""", "r_crm_sales_details")

q("decimal_cast", "SELECT prd_key, prd_cost, TRY_CAST(prd_cost AS DECIMAL(10,2)) AS cost FROM r_crm_prd_info",
  "r_crm_prd_info")
q("int_cast", """SELECT sls_ord_num, sls_prd_key, sls_quantity, TRY_CAST(sls_quantity AS INTEGER) AS quantity
FROM r_crm_sales_details""", "r_crm_sales_details")

q("date_compact", f"""
SELECT sls_ord_num, sls_prd_key, {_ymd('sls_order_dt')} AS order_date, {_ymd('sls_ship_dt')} AS ship_date,
       {_ymd('sls_due_dt')} AS due_date
FROM r_crm_sales_details""", "r_crm_sales_details")
q("date_us", """SELECT cst_key, cst_create_date,
       CAST(try_strptime(cst_create_date, '%m/%d/%Y') AS DATE) AS create_date FROM r_crm_cust_info""",
  "r_crm_cust_info")
q("date_iso", """SELECT CID, BDATE, CAST(try_strptime(BDATE, '%Y-%m-%d') AS DATE) AS birth_date
FROM r_erp_cust_az12""", "r_erp_cust_az12")

# ---- keys and dedup ------------------------------------------------------

SALES_REST = ["sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity",
              "sls_price"]
q("require_keys", """SELECT * FROM r_crm_sales_details
WHERE sls_ord_num IS NOT NULL AND sls_prd_key IS NOT NULL AND sls_cust_id IS NOT NULL""",
  "r_crm_sales_details")
q("dedupe_single", first_per_key("r_crm_cust_info", ["cst_key"], CUST_ORDER), "r_crm_cust_info")
q("dedupe_pair", first_per_key("r_crm_sales_details", ["sls_ord_num", "sls_prd_key"], SALES_REST),
  "r_crm_sales_details")
q("dedupe_repeated", first_per_key("r_crm_sales_details", ["sls_ord_num", "sls_prd_key"], SALES_REST),
  "r_crm_sales_details")
q("dedupe_latest", """
SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY sls_ord_num, sls_prd_key
  ORDER BY sls_ship_dt DESC NULLS LAST, sls_cust_id ASC NULLS FIRST, sls_order_dt ASC NULLS FIRST,
           sls_due_dt ASC NULLS FIRST, sls_sales ASC NULLS FIRST, sls_quantity ASC NULLS FIRST,
           sls_price ASC NULLS FIRST) AS __rn
  FROM r_crm_sales_details) WHERE __rn = 1""", "r_crm_sales_details")

q("lookup_orders", """
SELECT s.sls_ord_num, s.sls_prd_key, s.sls_cust_id, c.cst_lastname AS customer_name
FROM s_sales_details s LEFT JOIN s_crm_cust_info c ON s.sls_cust_id = c.cst_id""",
  "s_sales_details", "s_crm_cust_info")

# ---- checks --------------------------------------------------------------

q("count_all", "SELECT count(*) AS n_rows FROM g_fact_sales", "g_fact_sales")
q("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM s_sales_details"
    for c in ["sls_ord_num", "sls_prd_key"] + SALES_REST), "s_sales_details")
q("find_eq", "SELECT * FROM s_crm_cust_info WHERE cst_marital_status = 'Married'", "s_crm_cust_info")
q("find_num", "SELECT * FROM s_sales_details WHERE sls_quantity = 1", "s_sales_details")
q("find_gt", "SELECT * FROM g_fact_sales WHERE quantity > 1", "g_fact_sales")
q("find_null", "SELECT * FROM s_sales_details WHERE sls_sales IS NULL", "s_sales_details")
q("null_gender_count", "SELECT count(*) AS n_rows FROM r_crm_cust_info WHERE cst_gndr IS NULL",
  "r_crm_cust_info")
q("sample", "SELECT * FROM g_fact_sales ORDER BY order_number, product_key LIMIT 10", "g_fact_sales")
q("orphans", """
SELECT s.sls_ord_num, s.sls_prd_key, s.sls_cust_id FROM s_sales_details s
WHERE NOT EXISTS (SELECT 1 FROM s_prd_info p WHERE p.prd_id = s.sls_prd_key)""",
  "s_sales_details", "s_prd_info")
q("orphan_categories", """
SELECT p.prd_key, p.cat_id FROM s_prd_info p
WHERE NOT EXISTS (SELECT 1 FROM s_erp_px_cat_g1v2 k WHERE k.ID = p.cat_id)""",
  "s_prd_info", "s_erp_px_cat_g1v2")
q("unique_key", "SELECT CID, count(*) AS n_rows FROM s_loc_a101 GROUP BY CID HAVING count(*) > 1",
  "s_loc_a101")
q("reconcile", """
SELECT 'raw' AS stage, count(*) AS n_rows FROM r_crm_sales_details
UNION ALL SELECT 'keyed', count(*) FROM r_crm_sales_details
  WHERE sls_ord_num IS NOT NULL AND sls_prd_key IS NOT NULL AND sls_cust_id IS NOT NULL
UNION ALL SELECT 'silver', count(*) FROM s_sales_details
UNION ALL SELECT 'gold', count(*) FROM g_fact_sales""", "r_crm_sales_details", "s_sales_details",
  "g_fact_sales")
q("fact_fanout", """SELECT order_number, product_key, count(*) AS copies FROM g_fact_sales
GROUP BY order_number, product_key HAVING count(*) > 1""", "g_fact_sales")
q("lost_values", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE d.{c} IS NOT NULL AND s.{c} IS NULL) AS n_lost "
    f"FROM d_sales_details d JOIN s_sales_details s USING (sls_ord_num, sls_prd_key)"
    for c in ["sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity", "sls_price"]),
  "d_sales_details", "s_sales_details")

# ---- files, ingest, catalog ---------------------------------------------
# Landing layout written by tiers.plans.landing (stamps are fixed values).

STAMP, OLD = "20260101000000", "20251231000000"
LANDING = [("crm", f"{OLD}_cust_info.csv"), ("crm", f"{STAMP}_cust_info.csv"),
           ("crm", f"{STAMP}_prd_info.csv"), ("crm", f"{STAMP}_sales_details.csv"),
           ("crm", f"{STAMP}_empty-file.csv"), ("erp", f"{STAMP}_cust_az12.csv"),
           ("erp", f"{STAMP}_loc_a101.csv"), ("erp", f"{STAMP}_px_cat_g1v2.csv"),
           ("erp", f"{STAMP}_loc a101-bad.csv"),
           ("crm", f"{OLD}_prd_kept.csv"), ("crm", f"{STAMP}_prd_kept.csv"),
           ("erp", f"{OLD}_px_kept.csv"), ("erp", f"{STAMP}_px_kept.csv"), ("erp", f"{STAMP}_mixed.csv")]


def _table(subset: str, name: str, strip: bool = True) -> str:
    import re
    stem = name[:-4]
    if strip:
        stem = re.sub(r"^[0-9]+_", "", stem).replace("-", "_").replace(" ", "_")
    return f"{subset}_{stem}"


def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, str) and v.startswith("("):
            return v
        return "'" + str(v).replace("'", "''") + "'"
    return " UNION ALL ".join("SELECT " + ", ".join(
        f"{lit(v)} AS {n}" for n, v in r) for r in rows)


q("ingest_csv", f"""
SELECT CAST(cst_id AS INTEGER) AS cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status,
       cst_gndr, cst_create_date, '{STAMP}_cust_info.csv' AS _source_file
FROM r_crm_cust_info""", "r_crm_cust_info")
q("ingest_csv_strings", """
SELECT sls_ord_num, sls_prd_key, CAST(sls_cust_id AS VARCHAR) AS sls_cust_id,
       CAST(sls_order_dt AS VARCHAR) AS sls_order_dt, sls_ship_dt, CAST(sls_due_dt AS VARCHAR) AS sls_due_dt,
       sls_sales, sls_quantity, sls_price
FROM r_crm_sales_details""", "r_crm_sales_details")
q("ingest_csv_schema", "SELECT CID, BDATE, NULLIF(GEN, '') AS GEN FROM r_erp_cust_az12", "r_erp_cust_az12")
q("peek_text", """SELECT ID || ',' || CAT || ',' || SUBCAT || ',' || coalesce(MAINTENANCE, '') AS value
FROM r_erp_px_cat_g1v2""", "r_erp_px_cat_g1v2")
_COUNT = {"cust_info": "r_crm_cust_info", "prd_info": "r_crm_prd_info",
          "sales_details": "r_crm_sales_details", "cust_az12": "r_erp_cust_az12",
          "loc_a101": "r_erp_loc_a101", "px_cat_g1v2": "r_erp_px_cat_g1v2",
          "loc a101-bad": "r_erp_loc_a101", "prd_kept": "r_crm_prd_info", "px_kept": "r_erp_px_cat_g1v2"}
_INPUTS = tuple(dict.fromkeys(_COUNT.values()))


def _stem(name: str) -> str:
    return name[len(STAMP) + 1:-4]


def _rows_of(name: str) -> str:
    """The data rows of an export, counted from the given tables."""
    if _stem(name) == "empty-file" or name == f"{STAMP}_prd_kept.csv":
        return "(CAST(0 AS BIGINT))"
    if _stem(name) == "mixed":      # written twice, with the columns in either order
        return "(SELECT 2 * count(*) FROM r_erp_loc_a101)"
    return f"(SELECT count(*) FROM {_COUNT[_stem(name)]})"


q("list_files", _values([[("subset", s), ("name", n), ("is_dir", True), ("n_rows", _rows_of(n))] for s, n in LANDING]), *_INPUTS)
_NAMED = _values([[("table_name", _table(s, n)), ("stamped", _table(s, n, False)), ("n_rows", _rows_of(n))] for s, n in LANDING])
q("table_name", f"""SELECT table_name, CAST(sum(n_rows) AS BIGINT) AS n_rows, min(stamped) AS first_stamped, count(*) AS n_files
FROM ({_NAMED}) GROUP BY table_name""", *_INPUTS)
q("latest_files", _values([[("subset", s), ("name", n), ("table_name", _table(s, n)), ("n_rows", _rows_of(n))]
                           for s, n in LANDING if not n.startswith(OLD)]), *_INPUTS)


def _status(name: str) -> str:
    if name in (f"{STAMP}_prd_kept.csv", f"{STAMP}_empty-file.csv"):
        return "empty"
    if name == f"{STAMP}_px_kept.csv" or _stem(name) in ("loc a101-bad", "mixed"):
        return "failed"
    return "superseded" if name == f"{OLD}_cust_info.csv" else "ok"


def _report_rows():
    rows = []
    for s, n in LANDING:
        status = _status(n)
        rows.append([("subset", s), ("file_name", n), ("table_name", _table(s, n)), ("status", status),
                     ("rows", _rows_of(n) if status in ("ok", "empty") else "(CAST(NULL AS BIGINT))")])
    rows.append([("subset", "hr"), ("file_name", "(CAST(NULL AS VARCHAR))"),
                 ("table_name", "(CAST(NULL AS VARCHAR))"), ("status", "unreadable"),
                 ("rows", "(CAST(NULL AS BIGINT))")])
    return rows


q("ingest_report", _values(_report_rows()), *_INPUTS)
q("ingested_rows", _values([[("table_name", _table(s, n)), ("n_rows", _rows_of(n))]
                            for s, n in LANDING if _status(n) == "ok"]), *_INPUTS)

# A second ingest after a newer export of the category table: only that one is read.
NEW = "20260201000000"


def _again_rows():
    rows = []
    for s, n in LANDING:
        status = {"ok": "unchanged"}.get(_status(n), _status(n))
        count = _rows_of(n) if status in ("unchanged", "empty") else "(CAST(NULL AS BIGINT))"
        if n == f"{STAMP}_px_cat_g1v2.csv":
            status, count = "superseded", "(CAST(NULL AS BIGINT))"
        rows.append([("subset", s), ("file_name", n), ("table_name", _table(s, n)), ("status", status), ("rows", count)])
    rows.append([("subset", "erp"), ("file_name", f"{NEW}_px_cat_g1v2.csv"), ("table_name", "erp_px_cat_g1v2"), ("status", "ok"),
                 ("rows", "(SELECT count(*) FROM r_erp_px_cat_g1v2 WHERE CAT IS NOT NULL)")])
    return rows


q("ingest_again", _values(_again_rows()), *_INPUTS)
# of the other layers, only what reads the category table is built again
q("run_again", _values([[("layer", layer), ("table_name", t),
                         ("status", "ok" if t in ("erp_px_cat_g1v2", "dim_product") else "unchanged")]
                        for layer, names in (("silver", ("crm_cust_info", "prd_info", "sales_details", "erp_cust_az12",
                                                         "loc_a101", "erp_px_cat_g1v2")),
                                             ("gold", ("dim_customer", "dim_product", "fact_sales"))) for t in names]))
_KEYED = {"crm_cust_info": ("r_crm_cust_info", "cst_id IS NOT NULL AND cst_key IS NOT NULL"),
          "prd_info": ("r_crm_prd_info", "prd_id IS NOT NULL AND prd_key IS NOT NULL"),
          "sales_details": ("r_crm_sales_details",
                            "sls_ord_num IS NOT NULL AND sls_prd_key IS NOT NULL AND sls_cust_id IS NOT NULL"),
          "erp_cust_az12": ("r_erp_cust_az12", "CID IS NOT NULL"), "loc_a101": ("r_erp_loc_a101", "CID IS NOT NULL"),
          "erp_px_cat_g1v2": ("r_erp_px_cat_g1v2", "ID IS NOT NULL")}
_PARSED = {"crm_cust_info": {"cst_create_date": "try_strptime(cst_create_date, '%m/%d/%Y')"},
           "prd_info": {"prd_cost": "TRY_CAST(prd_cost AS DECIMAL(10,2))"},
           "sales_details": {c: _ymd(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")}
           | {c: _money(c) for c in ("sls_sales", "sls_price")} | {"sls_quantity": "TRY_CAST(sls_quantity AS INTEGER)"},
           "erp_cust_az12": {"BDATE": "try_strptime(CAST(BDATE AS VARCHAR), '%Y-%m-%d')"}}


def _counts(t: str) -> str:
    raw, keyed = _KEYED[t]
    n = {"rows_read": f"(SELECT count(*) FROM {raw})", "no_key": f"(SELECT count(*) FROM {raw} WHERE NOT ({keyed}))",
         "repeated": f"(SELECT count(*) FROM {raw} WHERE {keyed}) - (SELECT count(*) FROM d_{t})",
         "kept": f"(SELECT count(*) FROM d_{t})"}
    n |= {f"lost_{c}": f"(SELECT count(*) FROM d_{t} WHERE {c} IS NOT NULL AND {e} IS NULL)" for c, e in _PARSED.get(t, {}).items()}
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, 'ok' AS status, '{m}' AS measure, {e} AS n" for m, e in n.items())


q("bucketed_fact_sales", "SELECT * FROM g_fact_sales", "g_fact_sales")
q("silver_counts", " UNION ALL ".join(_counts(t) for t in _KEYED), *[r for r, _ in _KEYED.values()], *[f"d_{t}" for t in _KEYED])

# The stored layered run reads the exports back with type inference: ship dates
# become integers and unit prices doubles, which changes which duplicate the
# repeatable dedup keeps (trap T1); these CTEs carry the inferred types.
CTE["c_crm_sales_details"] = (("r_crm_sales_details",), """
SELECT sls_ord_num, sls_prd_key, CAST(sls_cust_id AS INTEGER) AS sls_cust_id, sls_order_dt,
       CAST(sls_ship_dt AS INTEGER) AS sls_ship_dt, sls_due_dt, sls_sales, sls_quantity,
       CAST(sls_price AS DOUBLE) AS sls_price
FROM r_crm_sales_details""")
CTE["cd_sales_details"] = (("c_crm_sales_details",), first_per_key(
    "(SELECT * FROM c_crm_sales_details WHERE sls_ord_num IS NOT NULL AND sls_prd_key IS NOT NULL "
    "AND sls_cust_id IS NOT NULL)", ["sls_ord_num", "sls_prd_key"], SALES_REST))
CTE["cs_sales_details"] = (("cd_sales_details",), f"""
SELECT sls_ord_num, sls_prd_key, sls_cust_id,
       {_ymd('sls_order_dt')} AS sls_order_dt, {_ymd('sls_ship_dt')} AS sls_ship_dt,
       {_ymd('sls_due_dt')} AS sls_due_dt, {_money('sls_sales')} AS sls_sales,
       TRY_CAST(sls_quantity AS INTEGER) AS sls_quantity, {_money('sls_price')} AS sls_price
FROM cd_sales_details""")
q("stored_fact_sales", """
SELECT s.sls_ord_num AS order_number, s.sls_prd_key AS product_key, s.sls_cust_id AS customer_id,
       s.sls_order_dt AS order_date, s.sls_sales AS sales_amount, s.sls_quantity AS quantity,
       s.sls_price AS price
FROM cs_sales_details s
LEFT JOIN s_prd_info p ON s.sls_prd_key = p.prd_id
LEFT JOIN s_crm_cust_info c ON s.sls_cust_id = c.cst_id""", "cs_sales_details", "s_prd_info", "s_crm_cust_info")
q("stored_dim_customer", """
SELECT CAST(customer_id AS INTEGER) AS customer_id, first_name, last_name, marital_status, crm_gender,
       NULLIF(erp_gender, '') AS erp_gender, birth_date, country FROM g_dim_customer""", "g_dim_customer")
q("stored_dim_product", "SELECT * FROM g_dim_product", "g_dim_product")
_STORED = [(t, f"s_{t}") for t in ("crm_cust_info", "prd_info", "sales_details", "erp_cust_az12", "loc_a101",
                                   "erp_px_cat_g1v2")] + [(t, f"g_{t}") for t in ("dim_customer", "dim_product", "fact_sales")]
q("stamps", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) AS n_stamped, least(count(*), 1) AS n_values FROM {c}"
    for t, c in _STORED), *[c for _, c in _STORED])
q("query_table", "SELECT * FROM g_dim_product WHERE category_name = 'ECONOMY'", "g_dim_product")
q("save_read_table", "SELECT * FROM s_erp_px_cat_g1v2", "s_erp_px_cat_g1v2")
_N_CUST = "(SELECT count(*) FROM s_crm_cust_info)"
q("schema_guard", _values([
    [("step", "first write"), ("outcome", "ok"), ("n_rows", _N_CUST)],
    [("step", "same schema"), ("outcome", "ok"), ("n_rows", _N_CUST)],
    [("step", "changed type"), ("outcome", "refused"), ("n_rows", "(CAST(NULL AS BIGINT))")],
    [("step", "after refusal"), ("outcome", "kept"), ("n_rows", _N_CUST)]]), "s_crm_cust_info")
q("catalog_list", _values(
    [[("table_name", t), ("column_name", c), ("n_planned", "(CAST(2 AS BIGINT))"),
      ("n_dropped", "(CAST(2 AS BIGINT))"), ("n_left", "(CAST(0 AS BIGINT))")]
     for t, cols in (("prd_info", ["prd_id", "prd_key", "prd_nm", "prd_line", "prd_cost", "cat_id"]),
                     ("erp_px_cat_g1v2", ["ID", "CAT", "SUBCAT", "MAINTENANCE"]))
     for c in cols]))
q("stream_ingest", "SELECT CID, CNTRY FROM r_erp_loc_a101", "r_erp_loc_a101")
