"""The star adapter of ``tessera.sources.star`` written as DuckDB SQL, for
the oracle side of every registered plan.  ``with_star(...)`` returns a
WITH clause defining the requested tables (dependencies included)."""

from __future__ import annotations

STAR_SQL = {
    "order_lines": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_item_id,
               l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
               CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS date_code,
               CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS total_price,
               CAST(l_discount AS DECIMAL(4,2)) AS discount,
               CAST(l_tax AS DECIMAL(4,2)) AS tax,
               l_returnflag AS return_flag, l_linestatus AS line_status,
               CAST(floor(epoch_us(l_shipdate) / 1000) AS BIGINT) AS dt_update
        FROM lineitem""",
    "order_items": """
        SELECT ol.order_item_id, ol.order_id, o.o_custkey AS customer_id, ol.product_id, ol.supplier_id,
               ol.date_code, ol.quantity, ol.total_price, ol.discount, ol.tax, ol.return_flag,
               ol.line_status, ol.dt_update
        FROM order_lines ol JOIN orders o ON ol.order_id = o.o_orderkey""",
    "customers": """
        SELECT c.c_custkey AS customer_id,
               '+' || CAST(n.n_nationkey + 10 AS VARCHAR) || printf('%09d', c.c_custkey) AS phone,
               printf('N%02d', n.n_nationkey) AS country_code,
               n.n_name AS country, r.r_name AS state, c.c_mktsegment AS city
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               'BRD-' || p_brand || '-' || p_type AS brand_code, 'CAT-' || p_type AS category_code,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_size AS size
        FROM part""",
    "brands": """
        SELECT DISTINCT
               'BRD-' || p_brand || '-' || p_type AS brand_code, p_brand AS brand_name,
               'BRD-' || upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) || '-' || p_type AS brand_label,
               'CAT-' || p_type AS category_code
        FROM part""",
    "category": """
        SELECT DISTINCT 'CAT-' || p_type AS category_code, p_type AS category_name FROM part""",
    "calendar": """
        SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_code,
               d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
               CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
               dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)),
                                                 INTERVAL 1 DAY)) AS DATE) AS d
              FROM lineitem) days""",
}

_DEPS = {"order_items": ["order_lines"]}
_ORDER = ["order_lines", "order_items", "customers", "products", "brands", "category", "calendar"]


def with_star(*names: str) -> str:
    wanted: set[str] = set()
    for n in names:
        wanted.add(n)
        wanted.update(_DEPS.get(n, []))
    parts = [f"{n} AS ({STAR_SQL[n]})" for n in _ORDER if n in wanted]
    return "WITH " + ",\n".join(parts) + "\n"
