"""What each query must return, as SQL over the same tables."""

_FACTS = """
    SELECT l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
           l_extendedprice AS price, CAST(l_shipdate AS DATE) AS sales_date
    FROM lineitem
"""


def _products(factor: int = 1, name: str = "p_name") -> str:
    return f"""
    SELECT p_partkey * {factor} AS product_id, {name} AS product_name,
           p_type AS category, p_brand AS brand
    FROM part
"""


def _summary(facts: str, products: str) -> str:
    return f"""
    SELECT f.sales_date, f.product_id, d.product_name,
           CAST(SUM(f.quantity) AS BIGINT) AS total_qty,
           SUM(f.quantity * f.price) AS gross_revenue
    FROM ({facts}) f LEFT JOIN ({products}) d ON f.product_id = d.product_id
    GROUP BY f.sales_date, f.product_id, d.product_name
"""


def _as_text(products: str) -> str:
    return f"SELECT * REPLACE (CAST(product_id AS VARCHAR) AS product_id) FROM ({products})"


def _upsert(target: str, source: str, match: str = "s.product_id = t.product_id") -> str:
    """Rows of the source, and those of the target it does not replace."""
    return f"""
    SELECT * FROM ({source})
    UNION ALL
    SELECT t.* FROM ({target}) t
    WHERE NOT EXISTS (SELECT 1 FROM ({source}) s WHERE {match})
"""


def _first(rows: str, keys: str, order: str) -> str:
    return f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM ({rows})
    ) WHERE rn = 1
"""


_SALES = """
    SELECT l_orderkey || '-' || l_linenumber AS sales_id,
           CAST(l_partkey AS VARCHAR) AS product_id,
           CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price,
           CAST(l_shipdate AS DATE) AS sales_date
    FROM lineitem
"""

_LINES = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity
    FROM lineitem
"""
_LATER = """
    SELECT l_orderkey, l_linenumber + 1 AS l_linenumber, l_partkey, l_suppkey, l_shipdate,
           l_quantity + 100 AS l_quantity
    FROM lineitem
"""
_LINE_KEYS = "l_orderkey, l_linenumber"
_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity"
_LINES_MERGED = _upsert(
    _first(_LINES, _LINE_KEYS, _LINE_ORDER),
    _first(_LATER, _LINE_KEYS, _LINE_ORDER),
    "s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber",
)

_FLAGGED = _LINES.replace("SELECT ", "SELECT l_returnflag, ", 1)
_FLAGGED_LATER = _LATER.replace("SELECT ", "SELECT 'R' AS l_returnflag, ", 1)

_KEYLESS = (
    "SELECT CASE WHEN brand = 'Brand#7' THEN NULL ELSE product_id END AS product_id, "
    "product_name, brand FROM ({})"
)

# Each table of rows below is of products; these are its two versions, old and incoming.
_OLD = _products()
_NEW = _products(2, "upper(p_name)")

ORACLES: dict[str, str] = {
    "gold_sales_summary": _summary(_FACTS, _products()),
    "gold_orphan_facts": _summary(_FACTS, _products(2)),
    "contract_rename_cast": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               p_retailprice AS price, p_size AS size
        FROM part
    """,
    "cast_int_legacy": """
        SELECT CAST(l_partkey AS INTEGER) AS fraction, -l_linenumber AS padded,
               0 AS only_fraction, CAST(NULL AS INTEGER) AS junk,
               CAST(NULL AS INTEGER) AS exponent,
               TRY_CAST('99999999' || l_partkey AS BIGINT) AS wide,
               TRY_CAST('99999999' || l_partkey AS BIGINT) AS wide_fraction,
               TRY_CAST('99999999' || l_partkey AS INTEGER) AS overflow
        FROM lineitem
    """,
    "cast_date": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS plain, CAST(o_orderdate AS DATE) AS short,
               CAST(o_orderdate AS DATE) AS with_time, CAST(NULL AS DATE) AS slashes,
               CAST(NULL AS DATE) AS compact,
               CAST(date_trunc('year', o_orderdate) AS DATE) AS only_year,
               CAST(NULL AS DATE) AS junk
        FROM orders
    """,
    "cast_boolean_default": """
        SELECT p_partkey,
               CASE WHEN p_size < 10 THEN true WHEN p_size < 30 THEN false END AS sold,
               CASE WHEN p_size >= 10 AND p_size < 30 THEN false ELSE true END AS sold_or_default,
               true AS active_flag, 0 AS stock
        FROM part
    """,
    "unknown_type_passthrough": """
        SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice AS price FROM part
    """,
    "audit_column": "SELECT p_partkey, true AS stamped, true AS is_query_time FROM part",
    "slug_names": """
        SELECT p_partkey,
               regexp_replace(p_name, '\\s+', '_', 'g') || '__' || p_size || '.v-1' AS slug,
               CASE WHEN p_size > 25 THEN 'sheet'
                    ELSE regexp_replace(p_brand, '[^A-Za-z0-9_.-]+', '', 'g') END AS short
        FROM part
    """,
    "na_tokens_to_null": """
        SELECT p_partkey,
               CASE WHEN p_size < 32 THEN NULL WHEN p_size < 40 THEN 'nA' ELSE p_name END AS cell,
               p_brand
        FROM part
    """,
    "not_null_split": """
        SELECT c_custkey, nullif(c_nationkey, 3) AS nation,
               nullif(c_mktsegment, 'BUILDING') AS segment,
               CASE WHEN c_nationkey = 3 AND c_mktsegment = 'BUILDING' THEN 'nation+segment'
                    WHEN c_nationkey = 3 THEN 'nation'
                    WHEN c_mktsegment = 'BUILDING' THEN 'segment' ELSE '' END AS missing
        FROM customer
    """,
    "not_null_absent_column": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'product_name' AS missing FROM part
    """,
    "not_null_required": _as_text(_OLD),
    "conform_case_variants": """
        SELECT p_partkey AS part_key, coalesce(nullif(p_size, 1), 0) AS "Size", false AS flag
        FROM part
    """,
    "dedupe_on_keys": _first(
        "SELECT * FROM lineitem",
        _LINE_KEYS,
        "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus",
    ),
    "merge_upsert": _upsert(_OLD, _NEW),
    "merge_target_only_column": f"""
        SELECT coalesce(s.product_id, t.product_id) AS product_id,
               coalesce(s.product_name, t.product_name) AS product_name, t.category, t.brand
        FROM ({_OLD}) t FULL JOIN ({_NEW}) s ON s.product_id = t.product_id
    """,
    "merge_new_column": f"""
        SELECT coalesce(s.product_id, t.product_id) AS product_id,
               coalesce(s.product_name, t.product_name) AS product_name, s.brand
        FROM ({_OLD}) t FULL JOIN ({_NEW}) s ON s.product_id = t.product_id
    """,
    "merge_composite_key": _LINES_MERGED,
    "merge_null_keys": _upsert(_KEYLESS.format(_OLD), _KEYLESS.format(_NEW)),
    "merge_first_write": _first(
        "SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber FROM lineitem",
        "l_partkey",
        "l_shipdate, l_orderkey, l_linenumber",
    ),
    "merge_published": _upsert(_OLD, _NEW),
    "merge_by_bucket": _upsert(_OLD, _NEW),
    "upsert_after_restart": _upsert(_OLD, _NEW),
    "merge_partitions": _upsert(
        _first(_FLAGGED, f"l_returnflag, {_LINE_KEYS}", _LINE_ORDER),
        _first(_FLAGGED_LATER, f"l_returnflag, {_LINE_KEYS}", _LINE_ORDER),
        "s.l_returnflag = t.l_returnflag AND s.l_orderkey = t.l_orderkey "
        "AND s.l_linenumber = t.l_linenumber",
    ),
    "silver_dim_product": _upsert(_as_text(_OLD), _as_text(_NEW)),
    "silver_fact_sales": f"""
        SELECT f.*, d.product_id IS NULL AS is_orphan
        FROM ({_first(_SALES, "sales_id", "sales_date, product_id, quantity, price")}) f
        LEFT JOIN ({_as_text(_products(2))}) d ON f.product_id = d.product_id
    """,
    # Of the two versions of a name the upper-case one sorts first.
    "bronze_load": _upsert(_as_text(_OLD), _as_text(_NEW)),
    "bronze_stream_load": _upsert(_as_text(_OLD), _as_text(_NEW)),
    "layers_end_to_end": _summary(
        _first(_SALES, "sales_id", "product_id, quantity, price, sales_date"), _as_text(_OLD)
    ),
    "gold_from_template": f"""
        SELECT sales_date, coalesce(category, 'none') AS category, count(*) AS sales,
               max(price) AS dearest, bool_or(quantity >= 45) AS any_large
        FROM ({_FACTS}) LEFT JOIN ({_products()}) USING (product_id) GROUP BY ALL
    """,
    "silver_from_template": f"""
        WITH sold AS (SELECT p_partkey, p_brand, CAST(SUM(l_quantity) AS BIGINT) AS q
                      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
        later AS (SELECT replace(p_brand, '1', '9') AS brand, CAST(SUM(q) AS BIGINT) AS sold
                  FROM sold GROUP BY 1)
        SELECT *, 'later' AS note FROM later
        UNION ALL
        SELECT p_brand, CAST(SUM(q) AS BIGINT), 'first' FROM sold
        WHERE p_brand NOT IN (SELECT brand FROM later) GROUP BY p_brand
    """,
    "merge_statement": """
        WITH old AS (SELECT p_partkey, p_name, p_size FROM part),
        new AS (SELECT 2 * p_partkey AS p_partkey, upper(p_name) AS label FROM part)
        SELECT coalesce(o.p_partkey, n.p_partkey) AS part_id, coalesce(label, p_name) AS label,
               p_size AS size, CASE WHEN o.p_partkey IS NOT NULL THEN 'it''s first' END AS note
        FROM old o FULL JOIN new n ON o.p_partkey = n.p_partkey
    """,
    "replace_statement": """
        WITH s AS (SELECT l_returnflag AS flag, p_size AS size, count(*) AS sales,
                          CAST(SUM(l_quantity) AS BIGINT) AS quantity
                   FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL)
        SELECT *, CAST(SUM(quantity) OVER (PARTITION BY flag) AS BIGINT) AS of_flag
        FROM s WHERE sales >= 2
    """,
    "csv_rows_quarantined": """
        SELECT 'accepted' AS outcome, count(*) AS rows, count(*) FILTER (p_size > 30) AS quoted
        FROM part WHERE p_size BETWEEN 11 AND 20 OR p_size > 30
        UNION ALL
        SELECT 'surplus cells', count(*), count(*) FROM part WHERE p_size <= 10
        UNION ALL SELECT 'missing cells', count(*), 0 FROM part WHERE p_size BETWEEN 21 AND 30
    """,
    "load_figures": """
        WITH n AS (SELECT count(*) AS n, count(*) FILTER (p_brand = 'Brand#7') AS bare,
                          count(*) FILTER (2 * p_partkey <= (SELECT max(p_partkey) FROM part)) AS known
                   FROM part)
        SELECT 1 AS load, 'read' AS what, n AS rows FROM n
        UNION ALL SELECT 1, 'rejected', 0
        UNION ALL SELECT 1, 'inserted', n FROM n
        UNION ALL SELECT 1, 'updated', 0
        UNION ALL SELECT 2, 'read', 2 * n FROM n
        UNION ALL SELECT 2, 'rejected', bare FROM n
        UNION ALL SELECT 2, 'inserted', n - known FROM n
        UNION ALL SELECT 2, 'updated', known FROM n
    """,
    "gold_changed_days": _summary(
        f"""
        WITH f AS ({_first(
            "SELECT l_orderkey || '-' || l_linenumber AS sales_id, f.* FROM (SELECT l_orderkey, l_linenumber, "
            "l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price, "
            "CAST(l_shipdate AS DATE) AS sales_date FROM lineitem) f",
            "sales_id", "product_id, quantity, price, sales_date",
        )}),
        y AS (SELECT year(max(sales_date)) AS last FROM f)
        SELECT product_id, quantity, CASE WHEN year(sales_date) = last THEN 2 * price ELSE price END AS price,
               CASE WHEN year(sales_date) = last THEN CAST(sales_date + INTERVAL 1 DAY AS DATE)
                    ELSE sales_date END AS sales_date
        FROM f, y
        """,
        _products(),
    ),
    "merge_wider_types": """
        WITH new AS (SELECT CAST(p_partkey * 2 + 1099511627776 AS BIGINT) AS id, p_size / 2 AS size FROM part
                     UNION ALL SELECT p_partkey * 2, p_retailprice FROM part)
        SELECT * FROM new
        UNION ALL
        SELECT p_partkey, CAST(p_size AS DOUBLE) FROM part WHERE p_partkey NOT IN (SELECT id FROM new)
    """,
    "sheet_files": f"""
        SELECT *, '商品 list' AS sheet, 'ok' AS status FROM ({_as_text(_OLD)})
    """,
    "text_encodings": """
        SELECT folder, CAST(p_partkey AS VARCHAR) AS number,
               translate(p_name, 'aeiou', 'アエイオウ') AS name
        FROM part, (VALUES ('sjis'), ('eucjp'), ('utf8'), ('wide')) f(folder)
        UNION ALL
        SELECT 'western', CAST(p_partkey AS VARCHAR), p_name || ' à 5 €' || p_size FROM part
        UNION ALL SELECT 'unclear', NULL, NULL
    """,
    "quoted_lines": """
        SELECT CAST(p_partkey AS VARCHAR) AS id,
               p_name || chr(10) || '"no",' || chr(10) || p_brand AS text, 'lines' AS folder FROM part
        UNION ALL
        SELECT CAST(p_partkey AS VARCHAR), p_partkey || '" screen', 'inch' FROM part
    """,
    "csv_scan": _as_text(_OLD),
    "csv_scan_nested": f"{_as_text(_OLD)} UNION ALL {_as_text(_products(2))}",
    "sniffed_text_scan": " UNION ALL ".join(
        f"""
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
               {"CAST(NULL AS VARCHAR)" if folder == "bar" else "p_brand"} AS p_brand,
               CAST(p_size AS VARCHAR) AS p_size, '{folder}' AS folder
        FROM part
        """
        for folder in ("comma", "semicolon", "tab", "bar")
    ),
    "workbook_scan": _as_text(_OLD),
    "workbook_manifest": """
        SELECT 'sheet' AS kind, 'Products' AS sheet, count(*) AS rows, false AS has_error FROM part
        UNION ALL SELECT 'sheet', 'Suppliers', count(*), false FROM supplier
        UNION ALL SELECT 'failed', NULL, NULL, true
    """,
    "text_outcomes": """
        SELECT 'sound' AS folder, 'text' AS status, CAST(count(*) AS BIGINT) AS rows FROM part
        UNION ALL SELECT 'one', 'text', count(*) FROM supplier
        UNION ALL SELECT 'bare', 'text', 0
        UNION ALL SELECT 'long', 'text', count(*) FROM part
        UNION ALL SELECT 'surplus', 'failed', NULL
    """,
    "text_ingest": """
        SELECT 'status text' AS what, 2 * count(*) AS rows FROM part
        UNION ALL SELECT 'brand ' || p_brand, 2 * count(*) FROM part GROUP BY p_brand
    """,
    "table_scan_write": f"""
        SELECT sales_date AS folder, sales_date, count(*) AS sales, CAST(SUM(quantity) AS BIGINT) AS quantity
        FROM ({_FACTS}) GROUP BY sales_date
    """,
    "create_then_overwrite": f"""
        SELECT *, CAST(0 AS BIGINT) AS rows_before FROM ({_as_text(_OLD)})
    """,
    "sql_template": """
        SELECT p_brand AS brand, count(*) AS parts, max(p_size) AS largest,
               count(*) FILTER (p_size >= 5) AS larger, '{"layer": "gold"}' AS tag
        FROM part GROUP BY p_brand
    """,
}
