"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark operators, in plain SQL over the driver
tables: the same landing derivation, the rules as one CASE, the calendar
from ``generate_series``, the hierarchy and product ids from
``row_number()``, the fact from a four-way join (the LIKE join itself in
substring mode) and the cube from ``GROUP BY CUBE``.
"""

from __future__ import annotations

from starloom.sources.testdata import AS_OF, LANDING_SQL

EARLY = "TIMESTAMP '1998-01-01 00:00:00'"
NOW = f"TIMESTAMP '{AS_OF}'"
TS_RE = r"^(\d{1,2})/(\d{1,2})/(\d{2}|\d{4}) (\d{1,2}):(\d{2})$"


def _g(i: int) -> str:
    return f"CAST(regexp_extract(order_date, '{TS_RE}', {i}) AS BIGINT)"


TS_EXPR = f"""CASE WHEN regexp_full_match(order_date, '{TS_RE[1:-1]}') THEN try(make_timestamp(
    CASE WHEN length(regexp_extract(order_date, '{TS_RE}', 3)) = 4 THEN {_g(3)}
         WHEN {_g(3)} < 70 THEN {_g(3)} + 2000 ELSE {_g(3)} + 1900 END,
    {_g(1)}, {_g(2)}, {_g(4)}, {_g(5)}, 0.0)) END"""

DIG = r"'\d+'"
PRICE = r"'\d+(\.\d{1,2})?'"


def _cleansing(landing_cte: str = "landing") -> str:
    return f"""
typed AS (
  SELECT *, trim(product) AS tproduct, trim(purchase_address) AS taddr,
    CASE WHEN regexp_full_match(order_id, {DIG}) THEN TRY_CAST(order_id AS BIGINT) END AS oid,
    CASE WHEN regexp_full_match(quantity_ordered, {DIG}) THEN TRY_CAST(quantity_ordered AS BIGINT) END AS qty,
    CASE WHEN regexp_full_match(price_each, {PRICE}) THEN TRY_CAST(price_each AS DECIMAL(18,2)) END AS price,
    {TS_EXPR} AS ts
  FROM {landing_cte}),
tagged AS (
  SELECT *, CASE
    WHEN NOT coalesce(regexp_full_match(order_id, {DIG}), false) THEN 'Invalid Order ID (non-numeric)'
    WHEN oid IS NULL THEN 'Order ID out of range'
    WHEN tproduct IS NULL THEN 'Product is NULL'
    WHEN NOT regexp_full_match(quantity_ordered, {DIG}) THEN 'Invalid Quantity Ordered'
    WHEN regexp_full_match(quantity_ordered, {DIG}) AND qty IS NULL THEN 'Quantity out of range'
    WHEN qty <= 0 THEN 'Quantity Ordered is not positive'
    WHEN NOT regexp_full_match(price_each, {PRICE}) THEN 'Invalid Price Each format'
    WHEN regexp_full_match(price_each, {PRICE}) AND price IS NULL THEN 'Price Each out of range'
    WHEN price <= 0 THEN 'Price Each is not positive'
    WHEN order_date IS NULL THEN 'Order Date is NULL'
    WHEN ts IS NULL THEN 'Invalid Order Date'
    WHEN ts > {NOW} THEN 'Order Date is in the future'
    WHEN taddr IS NULL THEN 'Purchase Address is NULL'
    WHEN quantity_ordered IS NULL OR price_each IS NULL THEN 'Unknown validation error'
  END AS error_reason FROM typed),
clean AS (
  SELECT oid AS order_id, upper(tproduct) AS product, qty AS quantity_ordered, price AS price_each,
         ts AS order_date, taddr AS purchase_address, updated_at
  FROM tagged WHERE error_reason IS NULL)"""


BASE = f"WITH landing AS ({LANDING_SQL}),{_cleansing()}"


def calendar_sql(src: str) -> str:
    """Calendar CTE body over the sale dates of relation ``src``."""
    return f"""
  SELECT * FROM (
    WITH b AS (SELECT min(year(order_date)) AS y0, max(year(order_date)) AS y1 FROM {src}),
    days AS (SELECT CAST(g.d AS DATE) AS d, b.y0 FROM b,
             generate_series(make_date(b.y0, 1, 1), make_date(b.y1, 12, 31), INTERVAL 1 DAY) AS g(d)
             WHERE b.y0 IS NOT NULL),
    k AS (SELECT d, y0, CAST(year(d) AS VARCHAR) AS y, CAST(month(d) AS VARCHAR) AS m,
                 CAST(quarter(d) AS VARCHAR) AS q, CASE WHEN month(d) <= 6 THEN '1' ELSE '2' END AS h,
                 CAST(isoyear(d) AS VARCHAR) AS iy, CAST(week(d) AS VARCHAR) AS w,
                 'D_' || strftime(d, '%Y%m%d') AS did FROM days)
    SELECT 'M_' || did AS time_combined_id, did AS time_id, strftime(d, '%Y-%m-%d') AS time_name,
           'M_' || y || m AS time_parent, '0' AS time_lvl, 'main' AS timebranch, d AS day_date FROM k
    UNION ALL
    SELECT 'W_' || did, did, strftime(d, '%Y-%m-%d'),
           CASE WHEN isoyear(d) >= y0 THEN 'W_' || iy || w END, '0', 'week', d FROM k
    UNION ALL
    SELECT DISTINCT 'M_M_' || y || m, 'M_' || y || m, y || '-' || m, 'Q_' || y || q, '1', 'main', NULL FROM k
    UNION ALL
    SELECT DISTINCT 'M_Q_' || y || q, 'Q_' || y || q, 'Q' || q || '-' || y, 'HY_' || y || h, '2', 'main', NULL FROM k
    UNION ALL
    SELECT DISTINCT 'M_HY_' || y || h, 'HY_' || y || h, 'HY_' || h || '-' || y, 'Y_' || y, '3', 'main', NULL FROM k
    UNION ALL
    SELECT DISTINCT 'M_Y_' || y, 'Y_' || y, y, NULL, '4', 'main', NULL FROM k
    UNION ALL
    SELECT DISTINCT 'W_W_' || iy || w, 'W_' || iy || w, 'W_' || w || '-' || iy, NULL, '1', 'week', NULL FROM k
  )"""


def addresses_sql(src: str) -> str:
    return f"""
  SELECT trim(street) AS street, trim(city) AS city, upper(state) AS state, postal_code FROM (
    SELECT DISTINCT street, city, state, postal_code FROM (
      SELECT trim(split_part(purchase_address, ',', 1)) AS street,
             trim(split_part(purchase_address, ',', 2)) AS city,
             trim(split_part(split_part(purchase_address, ',', 3), ' ', 2)) AS state,
             trim(split_part(purchase_address, ' ', -1)) AS postal_code
      FROM {src})
    WHERE street IS NOT NULL AND city IS NOT NULL AND state IS NOT NULL AND postal_code IS NOT NULL)
  WHERE regexp_full_match(postal_code, {DIG})"""


HIER_CTES = f"""
addr AS ({addresses_sql('landing')}),
cities AS (
  SELECT city, postal_code, state, p,
         p || '-C' || lpad(CAST(row_number() OVER (PARTITION BY p ORDER BY city) AS VARCHAR), 5, '0') AS id
  FROM (SELECT DISTINCT city, postal_code, state, 'S-' || state || trim(postal_code) AS p FROM addr)),
streets AS (
  SELECT street, city, postal_code, state, p,
         p || '-S' || lpad(CAST(row_number() OVER (PARTITION BY p ORDER BY street) AS VARCHAR), 5, '0') AS id
  FROM (SELECT DISTINCT a.street, a.city, a.postal_code, a.state, c.id AS p
        FROM addr a JOIN cities c ON a.city = c.city AND a.postal_code = c.postal_code AND a.state = c.state)),
hier AS (
  SELECT DISTINCT 'S-' || state AS address_id, state AS address_name, 'State' AS address_type,
         CAST(NULL AS VARCHAR) AS parent_id, 3 AS level FROM addr
  UNION ALL
  SELECT DISTINCT 'S-' || state || trim(postal_code), postal_code, 'Postal Code', 'S-' || state, 2 FROM addr
  UNION ALL SELECT id, city, 'City', p, 1 FROM cities
  UNION ALL SELECT id, street, 'Street', p, 0 FROM streets)"""

HIER_CITY_CTES = f"""
addr AS ({addresses_sql('landing')}),
postals AS (SELECT DISTINCT 'S-' || state || trim(postal_code) AS id, postal_code, state FROM addr),
first_postal AS (SELECT postal_code, min(id) AS p FROM postals GROUP BY postal_code),
cities AS (
  SELECT city, postal_code, p,
         p || '-C' || lpad(CAST(row_number() OVER (PARTITION BY p ORDER BY city, postal_code) AS VARCHAR), 5, '0') AS id
  FROM (SELECT DISTINCT a.city, a.postal_code, f.p FROM addr a JOIN first_postal f USING (postal_code))),
first_city AS (SELECT city, min(id) AS p FROM cities GROUP BY city),
streets AS (
  SELECT street, city, postal_code, p,
         p || '-S' || lpad(CAST(row_number() OVER (PARTITION BY p ORDER BY street, city, postal_code) AS VARCHAR), 5, '0') AS id
  FROM (SELECT DISTINCT a.street, a.city, a.postal_code, f.p FROM addr a JOIN first_city f USING (city))),
hier AS (
  SELECT DISTINCT 'S-' || state AS address_id, state AS address_name, 'State' AS address_type,
         CAST(NULL AS VARCHAR) AS parent_id, 3 AS level FROM addr
  UNION ALL
  SELECT id, postal_code, 'Postal Code', 'S-' || state, 2 FROM postals
  UNION ALL SELECT id, city, 'City', p, 1 FROM cities
  UNION ALL SELECT id, street, 'Street', p, 0 FROM streets)"""

# Nodes of the first arrival come first among their siblings, in name order, then the later ones.
HIER_TWO_RUNS_CTES = f"""
first_landing AS (SELECT * FROM landing WHERE updated_at = (SELECT min(updated_at) FROM landing)),
addr AS (SELECT street, city, state, postal_code, min(run) AS run FROM (
  SELECT *, 0 AS run FROM ({addresses_sql('first_landing')}) UNION ALL SELECT *, 1 FROM ({addresses_sql('landing')}))
  GROUP BY street, city, state, postal_code),
cities AS (
  SELECT city, postal_code, state, p,
         p || '-C' || lpad(CAST(row_number() OVER (PARTITION BY p ORDER BY run, city) AS VARCHAR), 5, '0') AS id
  FROM (SELECT city, postal_code, state, 'S-' || state || trim(postal_code) AS p, min(run) AS run FROM addr
        GROUP BY city, postal_code, state)),
streets AS (
  SELECT street, p, p || '-S' || lpad(CAST(row_number() OVER (PARTITION BY p ORDER BY run, street) AS VARCHAR), 5, '0') AS id
  FROM (SELECT a.street, c.id AS p, min(a.run) AS run FROM addr a JOIN cities c
        ON a.city = c.city AND a.postal_code = c.postal_code AND a.state = c.state GROUP BY a.street, c.id)),
hier AS (
  SELECT DISTINCT 'S-' || state AS address_id, state AS address_name, 'State' AS address_type,
         CAST(NULL AS VARCHAR) AS parent_id, 3 AS level FROM addr
  UNION ALL
  SELECT DISTINCT 'S-' || state || trim(postal_code), postal_code, 'Postal Code', 'S-' || state, 2 FROM addr
  UNION ALL SELECT id, city, 'City', p, 1 FROM cities
  UNION ALL SELECT id, street, 'Street', p, 0 FROM streets)"""

CATEGORY_ID = """CASE WHEN regexp_matches(upper({c}), 'MONITOR') THEN 'CAT-00001'
  WHEN regexp_matches(upper({c}), 'BATTERIES|BATTERY') THEN 'CAT-00002'
  WHEN regexp_matches(upper({c}), 'HEADPHONES') THEN 'CAT-00003'
  WHEN regexp_matches(upper({c}), 'TV') THEN 'CAT-00004'
  WHEN regexp_matches(upper({c}), 'DRYER|WASHING') THEN 'CAT-00005'
  WHEN regexp_matches(upper({c}), 'PHONE') THEN 'CAT-00006'
  WHEN regexp_matches(upper({c}), 'LAPTOP') THEN 'CAT-00007'
  WHEN regexp_matches(upper({c}), 'CABLE') THEN 'CAT-00008' ELSE 'CAT-00009' END"""
CATEGORY_NAME = """CASE WHEN regexp_matches(upper({c}), 'MONITOR') THEN 'MONITOR'
  WHEN regexp_matches(upper({c}), 'BATTERIES|BATTERY') THEN 'BATTERY'
  WHEN regexp_matches(upper({c}), 'HEADPHONES') THEN 'HEADPHONES'
  WHEN regexp_matches(upper({c}), 'TV') THEN 'TV'
  WHEN regexp_matches(upper({c}), 'DRYER|WASHING') THEN 'APPLIANCES'
  WHEN regexp_matches(upper({c}), 'PHONE') THEN 'PHONE'
  WHEN regexp_matches(upper({c}), 'LAPTOP') THEN 'LAPTOP'
  WHEN regexp_matches(upper({c}), 'CABLE') THEN 'ACCESSORIES' ELSE 'OTHERS' END"""


def closed_versions(ver: str) -> str:
    """SCD-2 columns over a relation (id, product_id, product, price_each, start_date)."""
    return f"""
  SELECT id, product_id, product, price_each, start_date,
    (SELECT min(w.start_date) FROM {ver} w WHERE w.product = v.product AND w.start_date > v.start_date)
      - INTERVAL 1 DAY AS end_date,
    start_date = max(start_date) OVER (PARTITION BY product) AS curr_status,
    {CATEGORY_ID.format(c='product')} AS parent_id, {CATEGORY_NAME.format(c='product')} AS category_name
  FROM {ver} v"""


PRODUCT_CTES = f"""
v AS (SELECT product, price_each, min(order_date) AS start_date FROM clean GROUP BY product, price_each),
names AS (SELECT product, 'PROD-' || lpad(CAST(row_number() OVER (ORDER BY min(start_date), product) AS VARCHAR), 5, '0') AS product_id
          FROM v GROUP BY product),
ver AS (SELECT row_number() OVER (ORDER BY start_date, product, price_each) AS id, names.product_id,
               v.product, v.price_each, v.start_date FROM v JOIN names USING (product)),
pdim AS ({closed_versions('ver')})"""


def fact_sql(address_match: str = "keyed", price_mode: str = "current", hier: str = "city_postal") -> str:
    ctes = HIER_CTES if hier == "city_postal" else HIER_CITY_CTES
    tdim = f"tdim AS ({calendar_sql('clean')}),"
    if price_mode == "current":
        pjoin = "JOIN pdim p ON upper(s.product) = upper(p.product) AND p.curr_status"
    else:
        pjoin = ("JOIN pdim p ON s.product = p.product AND round(s.price_each, 2) = round(p.price_each, 2) "
                 "AND s.order_date BETWEEN p.start_date AND coalesce(p.end_date, TIMESTAMP '9999-12-31')")
    if address_match == "keyed":
        state_cond = "AND k.state = upper(trim(split_part(split_part(s.purchase_address, ',', 3), ' ', 2)))" \
            if hier == "city_postal" else ""
        ajoin = f"""JOIN streets k ON k.street = trim(split_part(s.purchase_address, ',', 1))
               AND k.city = trim(split_part(s.purchase_address, ',', 2))
               AND k.postal_code = trim(split_part(s.purchase_address, ' ', -1)) {state_cond}
             JOIN hier a ON a.address_id = k.id"""
    else:
        # The LIKE join runs once per distinct address; sales then join its matches by equality.
        tdim += """
addr_match AS (SELECT DISTINCT s.purchase_address, a.address_id
               FROM (SELECT DISTINCT purchase_address FROM clean) s
               JOIN hier a ON s.purchase_address LIKE '%' || a.address_name || '%'),"""
        ajoin = """JOIN addr_match m ON m.purchase_address = s.purchase_address
             JOIN hier a ON a.address_id = m.address_id"""
    return f"""{BASE},{ctes},{PRODUCT_CTES},{tdim}
fact AS (
  SELECT s.order_id, s.quantity_ordered AS quantity,
         CAST(s.quantity_ordered * p.price_each AS DECIMAL(38,2)) AS total_price,
         CAST(p.id AS BIGINT) AS product_surrogate_id, p.product, t.time_id, a.address_id,
         CAST(p.start_date AS DATE) AS product_start_date, CAST(p.end_date AS DATE) AS product_end_date,
         p.curr_status AS product_current_status, p.parent_id AS product_parent_id,
         p.category_name AS product_category, t.day_date AS time_name, t.time_parent,
         t.time_lvl AS time_level, t.timebranch AS time_branch, a.address_name, a.address_type,
         a.parent_id, a.level AS address_level
  FROM clean s {pjoin}
  JOIN (SELECT * FROM tdim WHERE time_lvl = '0' AND timebranch = 'main') t ON CAST(s.order_date AS DATE) = t.day_date
  {ajoin}
  WHERE s.order_date IS NOT NULL)"""


FACT = fact_sql()
CUBE = f"""{FACT},
cube AS (SELECT product_surrogate_id, address_id, time_id,
                CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
         FROM fact GROUP BY CUBE (product_surrogate_id, time_id, address_id))"""


def _incremental_product() -> str:
    return f"""{BASE},
early AS (SELECT * FROM clean WHERE order_date < {EARLY}),
v1 AS (SELECT product, price_each, min(order_date) AS start_date FROM early GROUP BY product, price_each),
n1 AS (SELECT product, row_number() OVER (ORDER BY min(start_date), product) AS n FROM v1 GROUP BY product),
i1 AS (SELECT row_number() OVER (ORDER BY start_date, product, price_each) AS id, v1.* FROM v1),
v2 AS (SELECT c.product, c.price_each, min(c.order_date) AS start_date FROM clean c
       WHERE NOT EXISTS (SELECT 1 FROM v1 WHERE v1.product = c.product AND round(v1.price_each, 2) = round(c.price_each, 2))
       GROUP BY c.product, c.price_each),
n2 AS (SELECT product, (SELECT count(*) FROM n1) + row_number() OVER (ORDER BY min(start_date), product) AS n
       FROM v2 WHERE product NOT IN (SELECT product FROM n1) GROUP BY product),
i2 AS (SELECT (SELECT count(*) FROM v1) + row_number() OVER (ORDER BY start_date, product, price_each) AS id, v2.* FROM v2),
names AS (SELECT * FROM n1 UNION ALL SELECT * FROM n2),
ver AS (SELECT i.id, 'PROD-' || lpad(CAST(n.n AS VARCHAR), 5, '0') AS product_id, i.product, i.price_each, i.start_date
        FROM (SELECT * FROM i1 UNION ALL SELECT * FROM i2) i JOIN names n USING (product))
{closed_versions('ver')}"""


_FACT_AFTER_RUNS = """SELECT s.order_id, s.quantity_ordered AS quantity, CAST(s.quantity_ordered * p.price_each AS DECIMAL(38,2)) AS total_price,
  p.product, 'D_' || strftime(s.order_date, '%Y%m%d') AS time_id, k.street AS address_name
  FROM clean s JOIN pcur p ON upper(s.product) = upper(p.product)
  JOIN streets k ON k.street = trim(split_part(s.purchase_address, ',', 1))
   AND k.city = trim(split_part(s.purchase_address, ',', 2))
   AND k.postal_code = trim(split_part(s.purchase_address, ' ', -1))
   AND k.state = upper(trim(split_part(split_part(s.purchase_address, ',', 3), ' ', 2)))"""


def _warehouse_fact(landing_cte_sql: str) -> str:
    """The fact after three arrival runs: the same steps, another last SELECT."""
    steps, _, _ = _warehouse_totals(landing_cte_sql).partition("SELECT 'landing' AS table_name")
    return steps + _FACT_AFTER_RUNS


def _warehouse_totals(landing_cte_sql: str) -> str:
    """Three arrival runs, replayed in SQL: per-table (rows, amount) after the last run."""
    return f"""WITH landing AS ({landing_cte_sql}),
{_cleansing()},
runs AS (SELECT updated_at, dense_rank() OVER (ORDER BY updated_at) - 1 AS run FROM (SELECT DISTINCT updated_at FROM landing)),
c AS (SELECT clean.*, runs.run FROM clean JOIN runs USING (updated_at)),
e AS (SELECT tagged.*, runs.run FROM tagged JOIN runs USING (updated_at) WHERE error_reason IS NOT NULL),
firsts AS (SELECT product, price_each, min(run) AS r0 FROM c GROUP BY product, price_each),
pv AS (SELECT f.product, f.price_each, min(c.order_date) AS start_date FROM firsts f
       JOIN c ON c.product = f.product AND c.price_each = f.price_each AND c.run = f.r0
       GROUP BY f.product, f.price_each),
pcur AS (SELECT product, price_each FROM (SELECT *, max(start_date) OVER (PARTITION BY product) AS mx FROM pv)
         WHERE start_date = mx),
{HIER_CTES.strip()},
tdim AS ({calendar_sql('clean')}),
fact AS (
  SELECT CAST(s.quantity_ordered * p.price_each AS DECIMAL(38,2)) AS total_price,
         p.product || '|' || CAST(p.price_each AS VARCHAR) AS pkey,
         'D_' || strftime(s.order_date, '%Y%m%d') AS time_id, k.id AS address_id
  FROM clean s JOIN pcur p ON upper(s.product) = upper(p.product)
  JOIN streets k ON k.street = trim(split_part(s.purchase_address, ',', 1))
   AND k.city = trim(split_part(s.purchase_address, ',', 2))
   AND k.postal_code = trim(split_part(s.purchase_address, ' ', -1))
   AND k.state = upper(trim(split_part(split_part(s.purchase_address, ',', 3), ' ', 2)))),
cube_rows AS (SELECT 1 AS x FROM fact GROUP BY CUBE (pkey, time_id, address_id))
SELECT 'landing' AS table_name, count(*) AS row_count, CAST(0 AS DECIMAL(38,2)) AS amount FROM landing
UNION ALL SELECT 'clean', count(*), CAST(coalesce(sum(quantity_ordered * price_each), 0) AS DECIMAL(38,2)) FROM clean
UNION ALL SELECT 'errors', count(*), CAST(count(*) * (count(*) + 1) // 2 AS DECIMAL(38,2)) FROM e
UNION ALL SELECT 'time_dim', count(*), CAST(0 AS DECIMAL(38,2)) FROM tdim
UNION ALL SELECT 'location', count(*), CAST(0 AS DECIMAL(38,2)) FROM hier
UNION ALL SELECT 'product', count(*), CAST((SELECT coalesce(sum(price_each), 0) FROM pcur) AS DECIMAL(38,2)) FROM pv
UNION ALL SELECT 'fact', count(*), CAST(coalesce(sum(total_price), 0) AS DECIMAL(38,2)) FROM fact
UNION ALL SELECT 'cube', (SELECT count(*) FROM cube_rows), CAST(coalesce(sum(total_price), 0) * 8 AS DECIMAL(38,2)) FROM fact"""


def _fact_after_runs() -> str:
    """The whole fact after three arrival runs: ids are given in the order of runs and stay."""
    addresses = " UNION ALL ".join(
        f"SELECT *, {r} AS run FROM ({addresses_sql(f'(SELECT l.* FROM landing l JOIN runs USING (updated_at) WHERE run = {r})')})" for r in range(3))
    hierarchy = HIER_TWO_RUNS_CTES.partition("cities AS (")
    return f"""{BASE},
runs AS (SELECT updated_at, dense_rank() OVER (ORDER BY updated_at) - 1 AS run FROM (SELECT DISTINCT updated_at FROM landing)),
c AS (SELECT clean.*, runs.run FROM clean JOIN runs USING (updated_at)),
firsts AS (SELECT product, price_each, min(run) AS r0 FROM c GROUP BY product, price_each),
pv AS (SELECT f.product, f.price_each, f.r0, min(c.order_date) AS start_date FROM firsts f
       JOIN c ON c.product = f.product AND c.price_each = f.price_each AND c.run = f.r0 GROUP BY f.product, f.price_each, f.r0),
ver AS (SELECT row_number() OVER (ORDER BY r0, start_date, product, price_each) AS id, '' AS product_id, product, price_each, start_date FROM pv),
pdim AS ({closed_versions('ver')}),
addr AS (SELECT street, city, state, postal_code, min(run) AS run FROM ({addresses}) GROUP BY street, city, state, postal_code),
{hierarchy[1]}{hierarchy[2]},
street_ids AS (SELECT s.id, s.street, c.city, c.postal_code, c.state FROM streets s JOIN cities c ON s.p = c.id),
tdim AS ({calendar_sql('clean')}),
fact AS (
  SELECT s.order_id, s.quantity_ordered AS quantity, CAST(s.quantity_ordered * p.price_each AS DECIMAL(38,2)) AS total_price,
         CAST(p.id AS BIGINT) AS product_surrogate_id, p.product, t.time_id, a.address_id,
         CAST(p.start_date AS DATE) AS product_start_date, CAST(p.end_date AS DATE) AS product_end_date,
         p.curr_status AS product_current_status, p.parent_id AS product_parent_id, p.category_name AS product_category,
         t.day_date AS time_name, t.time_parent, t.time_lvl AS time_level, t.timebranch AS time_branch,
         a.address_name, a.address_type, a.parent_id, a.level AS address_level
  FROM clean s JOIN pdim p ON s.product = p.product AND p.curr_status
  JOIN (SELECT * FROM tdim WHERE time_lvl = '0' AND timebranch = 'main') t ON CAST(s.order_date AS DATE) = t.day_date
  JOIN street_ids k ON k.street = trim(split_part(s.purchase_address, ',', 1)) AND k.city = trim(split_part(s.purchase_address, ',', 2))
   AND k.postal_code = trim(split_part(s.purchase_address, ' ', -1))
   AND k.state = upper(trim(split_part(split_part(s.purchase_address, ',', 3), ' ', 2)))
  JOIN hier a ON a.address_id = k.id)"""


LANDING_AS_CSV = f"""SELECT coalesce(order_id, '') AS order_id, coalesce(product, '') AS product,
  coalesce(quantity_ordered, '') AS quantity_ordered, coalesce(price_each, '') AS price_each,
  coalesce(order_date, '') AS order_date, coalesce(purchase_address, '') AS purchase_address, updated_at
FROM ({LANDING_SQL})"""


ORACLE: dict[str, str] = {
    "clean_rows": f"{BASE} SELECT * FROM clean",
    "error_rows": f"""{BASE} SELECT order_id, tproduct AS product, quantity_ordered, price_each, order_date,
        taddr AS purchase_address, error_reason, updated_at AS logged_at, updated_at AS executed_time
        FROM tagged WHERE error_reason IS NOT NULL""",
    "error_counts": f"{BASE} SELECT error_reason, count(*) AS n FROM tagged WHERE error_reason IS NOT NULL GROUP BY 1",
    "surrogate_error_ids": f"""{BASE} SELECT order_id, tproduct AS product, quantity_ordered, price_each, order_date,
        taddr AS purchase_address, error_reason, updated_at AS logged_at, updated_at AS executed_time,
        row_number() OVER (ORDER BY order_id NULLS FIRST, tproduct NULLS FIRST, quantity_ordered NULLS FIRST,
          price_each NULLS FIRST, order_date NULLS FIRST, taddr NULLS FIRST, error_reason NULLS FIRST,
          updated_at NULLS FIRST) AS error_id
        FROM tagged WHERE error_reason IS NOT NULL""",
    "latest_batch": f"WITH landing AS ({LANDING_SQL}) SELECT * FROM landing WHERE updated_at >= (SELECT max(updated_at) FROM landing)",
    "anti_dedup": f"""{BASE},
        prev AS (SELECT * FROM clean WHERE updated_at < (SELECT max(updated_at) FROM landing))
        SELECT order_id, product, quantity_ordered, price_each, order_date, purchase_address, updated_at
        FROM typed t WHERE NOT EXISTS (SELECT 1 FROM prev e WHERE e.order_id = t.oid
          AND lower(trim(e.product)) = lower(t.tproduct) AND e.quantity_ordered = t.qty AND e.price_each = t.price
          AND e.order_date = t.ts AND trim(e.purchase_address) = t.taddr)""",
    "anti_dedup_pruned": f"""{BASE},
        prev AS (SELECT * FROM clean WHERE updated_at < (SELECT max(updated_at) FROM landing))
        SELECT order_id, product, quantity_ordered, price_each, order_date, purchase_address, updated_at
        FROM typed t WHERE order_date LIKE '01/%' AND NOT EXISTS (SELECT 1 FROM prev e WHERE e.order_id = t.oid
          AND lower(trim(e.product)) = lower(t.tproduct) AND e.quantity_ordered = t.qty AND e.price_each = t.price
          AND e.order_date = t.ts AND trim(e.purchase_address) = t.taddr)""",
    "time_dim": f"{BASE}, tdim AS ({calendar_sql('clean')}) SELECT * FROM tdim",
    "time_dim_increment": f"""{BASE}, early AS (SELECT * FROM clean WHERE order_date < {EARLY}),
        full_dim AS ({calendar_sql('clean')}), early_dim AS ({calendar_sql('early')})
        SELECT * FROM full_dim EXCEPT SELECT * FROM early_dim""",
    "except_days": f"""{BASE}, tdim AS ({calendar_sql('clean')})
        SELECT time_id FROM tdim WHERE time_lvl = '0' AND timebranch = 'main'
        EXCEPT SELECT 'D_' || strftime(order_date, '%Y%m%d') FROM clean""",
    "address_parts": f"""WITH landing AS ({LANDING_SQL})
        SELECT trim(split_part(purchase_address, ',', 1)) AS street, trim(split_part(purchase_address, ',', 2)) AS city,
               trim(split_part(split_part(purchase_address, ',', 3), ' ', 2)) AS state,
               trim(split_part(purchase_address, ' ', -1)) AS postal_code FROM landing""",
    "address_clean": f"WITH landing AS ({LANDING_SQL}) {addresses_sql('landing')}",
    "location_hierarchy": f"WITH landing AS ({LANDING_SQL}), {HIER_CTES.strip()} SELECT * FROM hier",
    "location_hierarchy_city": f"WITH landing AS ({LANDING_SQL}), {HIER_CITY_CTES.strip()} SELECT * FROM hier",
    "location_ids_incremental": f"WITH landing AS ({LANDING_SQL}), {HIER_TWO_RUNS_CTES.strip()} SELECT * FROM hier",
    "counter_wide": """SELECT o_orderkey * 37 AS n, CASE WHEN o_orderkey * 37 > 99999 THEN CAST(o_orderkey * 37 AS VARCHAR)
        ELSE right('00000' || CAST(o_orderkey * 37 AS VARCHAR), 5) END AS id_text FROM orders""",
    "product_category": f"""{BASE} SELECT product, {CATEGORY_ID.format(c='product')} AS parent_id,
        {CATEGORY_NAME.format(c='product')} AS category_name FROM (SELECT DISTINCT product FROM clean)""",
    "new_versions": f"""{BASE}, early AS (SELECT * FROM clean WHERE order_date < {EARLY})
        SELECT c.product, c.price_each, min(c.order_date) AS start_date FROM clean c
        WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.product = c.product AND round(e.price_each, 2) = round(c.price_each, 2))
        GROUP BY c.product, c.price_each""",
    "product_scd2": f"{BASE},{PRODUCT_CTES} SELECT * FROM pdim",
    "product_dim_incremental": _incremental_product(),
    # The two UPDATE steps over a dimension of open versions only.
    "scd2_reversion": f"""{BASE},{PRODUCT_CTES},
        step1 AS (SELECT d.id, d.product_id, d.product, d.price_each, d.start_date, d.parent_id, d.category_name,
          (SELECT min(s.order_date) FROM clean s WHERE s.product = d.product
             AND round(s.price_each, 2) <> round(d.price_each, 2) AND s.order_date > d.start_date) AS other
          FROM pdim d)
        SELECT id, product_id, product, price_each, start_date,
          CASE WHEN start_date <> (SELECT max(w.start_date) FROM step1 w WHERE w.product = step1.product)
               THEN other - INTERVAL 1 DAY END AS end_date,
          other IS NULL OR start_date = (SELECT max(w.start_date) FROM step1 w WHERE w.product = step1.product) AS curr_status,
          parent_id, category_name FROM step1""",
    "product_ids": f"SELECT DISTINCT product, product_id FROM ({_incremental_product()})",
    "orders_updated": f"""{BASE},{PRODUCT_CTES}
        SELECT s.order_id, s.product, d.id AS product_sk, d.parent_id AS category_id, s.price_each, s.order_date
        FROM clean s JOIN pdim d ON s.product = d.product AND round(s.price_each, 2) = round(d.price_each, 2)
         AND s.order_date BETWEEN d.start_date AND coalesce(d.end_date, TIMESTAMP '9999-12-31')""",
    "semi_active_versions": f"""{BASE},{PRODUCT_CTES}
        SELECT * FROM pdim d WHERE EXISTS (SELECT 1 FROM clean s WHERE s.product = d.product
          AND round(s.price_each, 2) <> round(d.price_each, 2) AND s.order_date > d.start_date)""",
    "order_fact_keyed": f"{FACT} SELECT * FROM fact",
    "order_fact_substring": f"{fact_sql('substring')} SELECT * FROM fact",
    "order_fact_as_of_sale": f"{fact_sql('keyed', 'as_of_sale')} SELECT * FROM fact",
    "order_fact_city": f"{fact_sql('keyed', 'current', 'city')} SELECT * FROM fact",
    "fact_append_twice": f"{FACT} SELECT * FROM fact UNION ALL SELECT * FROM fact",
    "sales_cube": f"{CUBE} SELECT * FROM cube",
    "sales_cube_substring": f"""{fact_sql('substring')},
        cube AS (SELECT product_surrogate_id, address_id, time_id, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
                 FROM fact GROUP BY CUBE (product_surrogate_id, time_id, address_id)) SELECT * FROM cube""",
    "cube_slice": f"""{FACT} SELECT product_surrogate_id, CAST(NULL AS VARCHAR) AS address_id, CAST(NULL AS VARCHAR) AS time_id,
        CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum FROM fact GROUP BY product_surrogate_id""",
    "cube_slice_stored": f"""{FACT} SELECT CAST(NULL AS BIGINT) AS product_surrogate_id, address_id, CAST(NULL AS VARCHAR) AS time_id,
        CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum FROM fact GROUP BY address_id""",
    "rollup_half": f"""{FACT} SELECT h.time_id, h.time_name, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
        FROM fact f JOIN tdim m ON m.time_id = f.time_parent AND m.timebranch = 'main'
        JOIN tdim q ON q.time_id = m.time_parent AND q.timebranch = 'main'
        JOIN tdim h ON h.time_id = q.time_parent AND h.timebranch = 'main' GROUP BY h.time_id, h.time_name""",
    "rollup_year": f"""{FACT} SELECT y.time_id, y.time_name, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
        FROM fact f JOIN tdim m ON m.time_id = f.time_parent AND m.timebranch = 'main'
        JOIN tdim q ON q.time_id = m.time_parent AND q.timebranch = 'main'
        JOIN tdim h ON h.time_id = q.time_parent AND h.timebranch = 'main'
        JOIN tdim y ON y.time_id = h.time_parent AND y.timebranch = 'main' GROUP BY y.time_id, y.time_name""",
    "rollup_city": f"""{FACT} SELECT c.address_id, c.address_name, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
        FROM fact f JOIN hier s ON s.address_id = f.address_id JOIN hier c ON c.address_id = s.parent_id
        GROUP BY c.address_id, c.address_name""",
    "rollup_postal": f"""{FACT} SELECT p.address_id, p.address_name, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
        FROM fact f JOIN hier s ON s.address_id = f.address_id JOIN hier c ON c.address_id = s.parent_id
        JOIN hier p ON p.address_id = c.parent_id GROUP BY p.address_id, p.address_name""",
    "rollup_month": f"""{FACT} SELECT f.time_parent AS time_id, t.time_name, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
        FROM fact f JOIN tdim t ON t.time_id = f.time_parent AND t.timebranch = 'main' GROUP BY f.time_parent, t.time_name""",
    "rollup_quarter": f"""{FACT} SELECT q.time_id, q.time_name, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
        FROM fact f JOIN tdim m ON m.time_id = f.time_parent AND m.timebranch = 'main'
        JOIN tdim q ON q.time_id = m.time_parent AND q.timebranch = 'main' GROUP BY q.time_id, q.time_name""",
    "rollup_state": f"""{FACT} SELECT st.address_id, st.address_name, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum
        FROM fact f JOIN hier s ON s.address_id = f.address_id JOIN hier c ON c.address_id = s.parent_id
        JOIN hier p ON p.address_id = c.parent_id JOIN hier st ON st.address_id = p.parent_id
        GROUP BY st.address_id, st.address_name""",
    "quality_report": f"""{FACT} SELECT 'quantity_positive' AS "check",
          count(*) FILTER (WHERE NOT coalesce(quantity > 0, false)) AS violations FROM fact
        UNION ALL SELECT 'total_price_present', count(*) FILTER (WHERE total_price IS NULL) FROM fact
        UNION ALL SELECT 'total_price_positive', count(*) FILTER (WHERE NOT coalesce(total_price > 0, false)) FROM fact
        UNION ALL SELECT 'product_present', count(*) FILTER (WHERE product_surrogate_id IS NULL) FROM fact
        UNION ALL SELECT 'time_present', count(*) FILTER (WHERE time_id IS NULL) FROM fact
        UNION ALL SELECT 'address_present', count(*) FILTER (WHERE address_id IS NULL) FROM fact
        UNION ALL SELECT 'current_product', count(*) FILTER (WHERE NOT coalesce(product_current_status, false)) FROM fact
        UNION ALL SELECT 'street_level', count(*) FILTER (WHERE NOT coalesce(address_level = 0, false)) FROM fact""",
    "key_report": f"""{FACT} SELECT 'time_key_unique' AS "check", count(*) - count(DISTINCT time_combined_id) AS violations FROM tdim
        UNION ALL SELECT 'address_key_unique', count(*) - count(DISTINCT address_id) FROM hier
        UNION ALL SELECT 'product_key_unique', count(*) - count(DISTINCT id) FROM pdim
        UNION ALL SELECT 'location_parent_exists', count(*) FROM hier c WHERE parent_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM hier p WHERE p.address_id = c.parent_id)
        UNION ALL SELECT 'fact_address_exists', count(*) FROM fact f WHERE address_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM hier h WHERE h.address_id = f.address_id)
        UNION ALL SELECT 'fact_time_exists', count(*) FROM fact f WHERE time_id IS NOT NULL AND NOT EXISTS
          (SELECT 1 FROM tdim t WHERE t.time_id = f.time_id AND t.time_lvl = '0' AND t.timebranch = 'main')
        UNION ALL SELECT 'fact_product_exists', count(*) FROM fact f WHERE product_surrogate_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM pdim p WHERE p.id = f.product_surrogate_id)""",
    "gated_run": f"""{FACT} SELECT * FROM (SELECT 'product_key_unique' AS "check", count(*) AS violations FROM pdim WHERE category_name = 'TV'
        UNION ALL SELECT 'location_parent_exists', count(*) FROM hier WHERE level = 0) WHERE violations > 0""",
    "scalar_text": f"""WITH landing AS ({LANDING_SQL}) SELECT trim(product) AS trimmed, lower(trim(product)) AS lowered,
        upper(product) AS uppered, split_part(purchase_address, ',', 2) AS second_part,
        split_part(purchase_address, ' ', -1) AS last_word, substring(order_date, 7, 4) AS year_text,
        CAST(length(purchase_address) AS INTEGER) AS addr_len, lpad(quantity_ordered, 5, '0') AS padded_qty,
        'S-' || order_id AS prefixed, coalesce(product, '?') AS product_or_mark FROM landing""",
    "scalar_date_num": f"""{BASE} SELECT order_id, CAST(year(order_date) AS INTEGER) AS y, CAST(month(order_date) AS INTEGER) AS m,
        CAST(day(order_date) AS INTEGER) AS d, CAST(week(order_date) AS INTEGER) AS iso_week,
        CAST(isoyear(order_date) AS INTEGER) AS iso_year, CAST(order_date AS DATE) + 30 AS plus_30,
        order_date - INTERVAL 1 DAY AS minus_day, round(price_each, 1) AS rounded,
        CAST(quantity_ordered * price_each AS DECIMAL(38,2)) AS line_total FROM clean""",
    "landing_roundtrip": f"""WITH landing AS ({LANDING_SQL}) SELECT coalesce(order_id, '') AS order_id,
        coalesce(product, '') AS product, coalesce(quantity_ordered, '') AS quantity_ordered,
        coalesce(price_each, '') AS price_each, coalesce(order_date, '') AS order_date,
        coalesce(purchase_address, '') AS purchase_address, TIMESTAMP '2024-01-04 00:00:00' AS updated_at FROM landing""",
    "landing_mixed_headers": f"""WITH landing AS ({LANDING_SQL}) SELECT coalesce(order_id, '') AS order_id, coalesce(product, '') AS product,
        CASE WHEN updated_at = TIMESTAMP '2024-01-03' THEN '' ELSE coalesce(quantity_ordered, '') END AS quantity_ordered,
        coalesce(price_each, '') AS price_each, coalesce(order_date, '') AS order_date,
        coalesce(purchase_address, '') AS purchase_address, TIMESTAMP '2024-01-04 00:00:00' AS updated_at FROM landing""",
    "landing_malformed": f"""WITH landing AS ({LANDING_SQL}), marked AS (SELECT *, CASE day(updated_at) WHEN 2 THEN 'Too few fields'
        WHEN 3 THEN 'Too many fields' ELSE CASE WHEN purchase_address IS NULL THEN 'Unclosed quote' END END AS error_reason FROM landing)
        SELECT coalesce(order_id, '') AS order_id, coalesce(product, '') AS product, coalesce(price_each, '') AS price_each, error_reason,
        TIMESTAMP '2024-01-04 00:00:00' AS logged_at FROM marked WHERE error_reason IS NOT NULL""",
    "warehouse_totals": _warehouse_totals(LANDING_SQL),
    "warehouse_fact": _warehouse_fact(LANDING_SQL),
    "warehouse_fact_incremental": f"{_fact_after_runs()} SELECT * FROM fact",
    "cube_delta": f"""{_fact_after_runs()} SELECT product_surrogate_id, address_id, time_id,
        CAST(sum(total_price) AS DECIMAL(38,2)) AS total_price_sum FROM fact GROUP BY CUBE (product_surrogate_id, time_id, address_id)""",
    "stream_equals_batch": _warehouse_totals(LANDING_AS_CSV),
}
