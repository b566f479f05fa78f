"""DuckDB statements with the results the registered queries must give.

They are written against the given tables and share no code with the package but the
declared column names. Rounded rates use integer arithmetic, so that they are exact.
"""

from __future__ import annotations

from punctual import schema

STAGING = """
lines AS (
  SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                      date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)),
                      CAST(l_quantity AS INTEGER)) AS item
  FROM lineitem
),
per_order AS (
  SELECT l_orderkey AS k, CAST(max(l_shipdate) AS DATE) AS shipped,
         min(l_returnflag) AS payment
  FROM lines GROUP BY l_orderkey
),
order_facts AS (
  SELECT o.*, p.shipped, p.payment, c.c_mktsegment, c.c_nationkey, c.c_custkey,
         n.n_name, r.r_name,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
              WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END AS mode,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
              WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS sched,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4
              WHEN '3-MEDIUM' THEN 3 ELSE 2 END AS sched_loose,
         ((date_diff('day', CAST(o.o_orderdate AS DATE), p.shipped) % 7) + 7) % 7 AS real_days
  FROM orders o JOIN per_order p ON p.k = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
),
categories AS (
  SELECT name, CAST(row_number() OVER (ORDER BY substr(md5(name), 1, 2), name) AS INTEGER) AS id
  FROM (SELECT DISTINCT p_type AS name FROM part WHERE p_type IS NOT NULL)
),
departments AS (
  SELECT name, CAST(row_number() OVER (ORDER BY substr(md5(name), 1, 2), name) AS INTEGER) AS id
  FROM (SELECT DISTINCT p_brand AS name FROM part WHERE p_brand IS NOT NULL)
),
stg AS (
  SELECT CAST(NULL AS BIGINT) AS row_id, l.l_orderkey AS order_id, l.item AS order_item_id,
    CAST(o.o_orderdate AS DATE) AS order_date, o.shipped AS shipping_date,
    o.mode AS shipping_mode, CAST(o.real_days AS INTEGER) AS days_for_shipping_real,
    CAST(o.sched AS INTEGER) AS days_for_shipment_sched,
    CAST(o.real_days > o.sched AS INTEGER) AS late_delivery_risk,
    CASE WHEN o.real_days > o.sched THEN 'Late delivery' ELSE 'On time' END AS delivery_status,
    o.o_orderstatus AS order_status, o.payment AS payment_type,
    o.o_custkey AS customer_id, CAST(NULL AS BIGINT) AS order_customer_id,
    o.c_mktsegment AS customer_segment,
    'CITY_' || o.c_nationkey || '_' || (o.c_custkey % 4) AS customer_city,
    'STATE_' || o.c_nationkey || '_' || (o.c_custkey % 2) AS customer_state,
    o.n_name AS customer_country,
    l.l_partkey AS product_card_id, p.p_name AS product_name,
    CAST(p.p_retailprice AS DECIMAL(18,2)) AS product_price,
    CAST(NULL AS INTEGER) AS product_status,
    ct.id AS category_id,
    p.p_type AS category_name,
    dt.id AS department_id,
    p.p_brand AS department_name,
    'CITY_' || o.c_nationkey || '_' || (o.c_custkey % 4) AS order_city,
    'STATE_' || o.c_nationkey || '_' || (o.c_custkey % 2) AS order_state,
    o.n_name AS order_country, o.n_name AS order_region, o.r_name AS market,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS sales,
    CAST(NULL AS DECIMAL(18,2)) AS sales_per_customer,
    CAST(l.l_quantity AS INTEGER) AS order_item_quantity,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2))
         AS DECIMAL(18,2)) AS order_item_discount,
    CAST(l.l_discount AS DECIMAL(18,2)) AS order_item_discount_rate,
    CAST(NULL AS DECIMAL(18,2)) AS order_item_product_price,
    CAST(NULL AS DECIMAL(18,2)) AS order_item_profit_ratio,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2)))
         AS DECIMAL(18,2)) AS order_item_total,
    CAST(NULL AS DECIMAL(18,2)) AS order_profit_per_order,
    CAST(NULL AS DECIMAL(18,2)) AS benefit_per_order
  FROM lines l JOIN order_facts o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN categories ct ON ct.name = p.p_type LEFT JOIN departments dt ON dt.name = p.p_brand
),
items AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id
    ORDER BY sales, order_item_discount, order_item_discount_rate) AS rn FROM stg) WHERE rn = 1
)"""

DIMENSIONS = """,
dim_customer AS (
  SELECT customer_id, customer_segment, customer_city, customer_state, customer_country
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC NULLS LAST,
          customer_segment NULLS FIRST, customer_city NULLS FIRST, customer_state NULLS FIRST,
          customer_country NULLS FIRST) AS rn
        FROM stg WHERE customer_id IS NOT NULL) WHERE rn = 1
),
dim_product AS (
  SELECT product_card_id, product_price, product_name, product_status, category_id,
         category_name, department_id, department_name
  FROM (SELECT *, row_number() OVER (PARTITION BY product_card_id
          ORDER BY order_date DESC NULLS LAST, product_price NULLS FIRST, product_name NULLS FIRST) AS rn
        FROM stg WHERE product_card_id IS NOT NULL) WHERE rn = 1
),
dim_geography AS (
  SELECT row_number() OVER (ORDER BY substr(md5(concat_ws('|', coalesce(order_city, ''),
           coalesce(order_state, ''), coalesce(order_country, ''), coalesce(order_region, ''),
           coalesce(market, ''))), 1, 2), order_city NULLS FIRST, order_state NULLS FIRST,
           order_country NULLS FIRST, order_region NULLS FIRST, market NULLS FIRST) AS geography_id, *
  FROM (SELECT DISTINCT order_city, order_state, order_country, order_region, market FROM stg)
),
dim_shipping_mode AS (
  SELECT row_number() OVER (ORDER BY substr(md5(shipping_mode), 1, 2), shipping_mode)
         AS shipping_mode_id, *
  FROM (SELECT DISTINCT shipping_mode FROM stg WHERE shipping_mode IS NOT NULL)
),
dim_date AS (
  SELECT row_number() OVER (ORDER BY substr(md5(CAST(full_date AS VARCHAR)), 1, 2), full_date)
         AS date_id, full_date, CAST(year(full_date) AS INTEGER) AS year,
         CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
         dayname(full_date) AS weekday
  FROM (SELECT order_date AS full_date FROM stg WHERE order_date IS NOT NULL
        UNION SELECT shipping_date FROM stg WHERE shipping_date IS NOT NULL)
)"""

# Keys are looked up: a place as one list, modes and days in maps. The other columns of
# the fact are the declared ones.
_LOOKED_UP = {
    "geography_id": "place_ids.id", "shipping_mode_id": "modes.ids[i.shipping_mode]",
    "order_date_id": "days.ids[i.order_date]", "shipping_date_id": "days.ids[i.shipping_date]",
}
_FACT_COLUMNS = ", ".join(
    f"{_LOOKED_UP.get(c, f'i.{c}')} AS {c}"
    for c in schema.table_schemas()["fact_order_items"].fieldNames()
)
FACT = f""",
days AS (SELECT map(list(full_date), list(date_id)) AS ids FROM dim_date),
modes AS (SELECT map(list(shipping_mode), list(shipping_mode_id)) AS ids FROM dim_shipping_mode),
place_ids AS (
  SELECT geography_id AS id, to_json([{", ".join(schema.GEOGRAPHY)}]) AS place FROM dim_geography
),
fact AS (
  SELECT {_FACT_COLUMNS}
  FROM days, modes, (SELECT *, to_json([{", ".join(schema.GEOGRAPHY)}]) AS place FROM items) i
  LEFT JOIN place_ids USING (place)
)"""

# Flat order grain: the first item, kept whole, with the names still attached.
ORDERS = """,
v AS (
  SELECT unnest(min_by(items, order_item_id)) FROM items GROUP BY order_id
),
totals AS (
  SELECT order_id, sum(sales) AS total_sales, max(days_for_shipment_sched) AS max_sched
  FROM items GROUP BY order_id
)"""

SCORES = """,
region_mode AS (
  SELECT order_region, shipping_mode, count(*) AS n, sum(late_delivery_risk) AS late
  FROM v GROUP BY ALL
),
world AS (SELECT CAST(sum(late) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS rate FROM region_mode),
shrunk AS (
  SELECT order_region, shipping_mode, n, late, CAST(late AS DOUBLE) / CAST(n AS DOUBLE) AS raw,
    (CAST(n AS DOUBLE) * (CAST(late AS DOUBLE) / CAST(n AS DOUBLE)) + 100.0 * rate)
      / (CAST(n AS DOUBLE) + 100.0) AS score
  FROM region_mode, world
),
by_score AS (
  SELECT round(score, 9) AS score, CAST(sum(late) AS HUGEINT) AS pos,
         CAST(sum(n - late) AS HUGEINT) AS neg
  FROM shrunk GROUP BY 1
),
curve AS (
  SELECT score, pos, neg,
    sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
    sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
    (SELECT sum(pos) FROM by_score) AS p, (SELECT sum(neg) FROM by_score) AS q
  FROM by_score
)"""

ALLOCATION = """,
cell AS (
  SELECT market, shipping_mode, count(*) AS n,
         CAST(sum(CAST(days_for_shipping_real > CASE shipping_mode WHEN 'Same Day' THEN 5
           WHEN 'First Class' THEN 4 WHEN 'Second Class' THEN 3 ELSE 2 END AS INTEGER)) AS DOUBLE)
           AS late
  FROM v GROUP BY ALL
),
whole AS (SELECT sum(n) AS n, sum(late) AS late, sum(late) / sum(n) AS rate FROM cell),
choice AS (
  SELECT c.market, c.shipping_mode, vol.n AS volume,
    vol.n * CASE c.shipping_mode WHEN 'Same Day' THEN 4 WHEN 'First Class' THEN 3
                 WHEN 'Second Class' THEN 2 ELSE 1 END AS cost,
    vol.n * ((c.n * (c.late / c.n) + 100 * w.rate) / (c.n + 100)) AS late,
    c.n * ((c.n * (c.late / c.n) + 100 * w.rate) / (c.n + 100)) AS mixed
  FROM cell c JOIN (SELECT market, sum(n) AS n FROM cell GROUP BY market) vol USING (market), whole w
),
plans AS (
  SELECT a.cost + b.cost + c.cost + d.cost + e.cost AS cost,
         a.late + b.late + c.late + d.late + e.late AS late,
         [a.shipping_mode, b.shipping_mode, c.shipping_mode, d.shipping_mode, e.shipping_mode] AS modes
  FROM choice a, choice b, choice c, choice d, choice e
  WHERE a.market = 'AFRICA' AND b.market = 'AMERICA' AND c.market = 'ASIA'
    AND d.market = 'EUROPE' AND e.market = 'MIDDLE EAST'
),
budgets AS (SELECT CAST(unnest({budgets}) AS DOUBLE) AS budget),
best AS (
  SELECT b.budget, arg_min(p.cost, p.late) AS cost, min(p.late) AS late,
         arg_min(p.modes, p.late) AS modes
  FROM budgets b LEFT JOIN plans p ON p.cost <= b.budget * (SELECT n FROM whole)
  GROUP BY b.budget
)"""


# The same for the regions of each market, and for all regions at once. Regions are
# added one by one; a partial plan is kept if no cheaper one is as good.
REGION_CHOICES = """,
cell AS (
  SELECT market, order_region, shipping_mode, count(*) AS n,
         CAST(sum(CAST(days_for_shipping_real > CASE shipping_mode WHEN 'Same Day' THEN 5
           WHEN 'First Class' THEN 4 WHEN 'Second Class' THEN 3 ELSE 2 END AS INTEGER)) AS DOUBLE)
           AS late
  FROM v GROUP BY ALL
),
world AS (SELECT sum(late) / sum(n) AS rate FROM cell),
choice AS (
  SELECT {scope} AS scope, dense_rank() OVER (PARTITION BY {scope} ORDER BY c.order_region) AS step,
    CAST(vol.n * CASE c.shipping_mode WHEN 'Same Day' THEN 4 WHEN 'First Class' THEN 3
                 WHEN 'Second Class' THEN 2 ELSE 1 END AS BIGINT) AS cost,
    vol.n * ((c.n * (c.late / c.n) + 100 * w.rate) / (c.n + 100)) AS late,
    c.n * ((c.n * (c.late / c.n) + 100 * w.rate) / (c.n + 100)) AS mixed, c.n, c.late AS raw_late
  FROM cell c
  JOIN (SELECT order_region, sum(n) AS n FROM cell GROUP BY 1) vol USING (order_region), world w
),
plans AS (
  SELECT scope, CAST(0 AS BIGINT) AS step, CAST(0 AS BIGINT) AS cost, CAST(0 AS DOUBLE) AS late
  FROM (SELECT DISTINCT scope FROM choice)
  UNION ALL
  SELECT scope, step, cost, late FROM (
    SELECT scope, step, cost, late, min(late) OVER (PARTITION BY scope ORDER BY cost, late
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS better
    FROM (SELECT p.scope, CAST(p.step + 1 AS BIGINT) AS step,
                 CAST(p.cost + c.cost AS BIGINT) AS cost, p.late + c.late AS late
          FROM plans p JOIN choice c ON c.scope = p.scope AND c.step = p.step + 1))
  WHERE better IS NULL OR late < better
),
totals_by_scope AS (
  SELECT scope, CAST(sum(n) AS BIGINT) AS n, sum(raw_late) AS baseline, sum(mixed) AS adjusted,
         max(step) AS last FROM choice GROUP BY scope
),
best AS (
  SELECT t.scope, b.budget, t.n, t.baseline, t.adjusted,
         arg_min(p.cost, p.late) AS cost, min(p.late) AS late
  FROM totals_by_scope t
  CROSS JOIN (SELECT CAST(unnest([0.5, 1.0, 1.5, 2.0, 2.5, 3.0]) AS DOUBLE) AS budget) b
  LEFT JOIN plans p ON p.scope = t.scope AND p.step = t.last AND p.cost <= b.budget * t.n
  GROUP BY ALL
)"""


# One instance of all regions by order month: hull corners by pairs of options, upgrades
# ranked by window, and the first upgrade that a budget does not reach.
LARGE = """,
cell AS (
  SELECT order_region || ' ' || strftime(order_date, '%Y-%m') AS place, shipping_mode, count(*) AS n,
         CAST(sum(CAST(days_for_shipping_real > CASE shipping_mode WHEN 'Same Day' THEN 5
           WHEN 'First Class' THEN 4 WHEN 'Second Class' THEN 3 ELSE 2 END AS INTEGER)) AS DOUBLE)
           AS late
  FROM v GROUP BY ALL
),
world AS (SELECT sum(late) / sum(n) AS rate FROM cell),
opt AS (
  SELECT place, shipping_mode AS m,
    vol.n * CASE shipping_mode WHEN 'Same Day' THEN 4.0 WHEN 'First Class' THEN 3.0
            WHEN 'Second Class' THEN 2.0 ELSE 1.0 END::DOUBLE AS cost,
    vol.n * ((c.n * (c.late / c.n) + 100 * w.rate) / (c.n + 100)) AS late
  FROM cell c JOIN (SELECT place, CAST(sum(n) AS DOUBLE) AS n FROM cell GROUP BY 1) vol USING (place), world w
  WHERE place IS NOT NULL
),
sound AS (
  SELECT * FROM opt o WHERE NOT EXISTS (
    SELECT 1 FROM opt p WHERE p.place = o.place AND p.cost <= o.cost AND p.late <= o.late
      AND (p.cost < o.cost OR p.late < o.late OR p.m < o.m))
),
corner AS (
  SELECT o.place, o.m, o.cost, o.late FROM sound o JOIN sound p ON p.place = o.place GROUP BY ALL
  HAVING coalesce(min((p.late - o.late) / (o.cost - p.cost)) FILTER (p.cost < o.cost), 'inf'::DOUBLE)
    > coalesce(max((o.late - p.late) / (p.cost - o.cost)) FILTER (p.cost > o.cost), -1)
),
stepped AS (
  SELECT *, row_number() OVER r - 1 AS step, cost - lag(cost) OVER r AS more, lag(late) OVER r - late AS saved
  FROM corner WINDOW r AS (PARTITION BY place ORDER BY cost)
),
ranking AS (
  SELECT *, sum(more) OVER (ORDER BY round(saved / more, 9) DESC, place, step) AS through,
         round(saved / more, 9) AS per_cost
  FROM stepped WHERE step > 0
),
base AS (
  SELECT sum(cost) AS cost, sum(late) AS late, count(*) AS places,
         (SELECT sum(n) FROM cell WHERE place IS NOT NULL) AS n FROM stepped WHERE step = 0
),
asked AS (
  SELECT budget, b.*, budget * b.n * (1 + 1e-12) - b.cost AS slack
  FROM base b, (SELECT CAST(unnest({budgets}) AS DOUBLE) AS budget)
),
reach AS (
  SELECT budget, count(*) FILTER (through <= slack) AS n_upgrades,
    coalesce(sum(more) FILTER (through <= slack), 0) AS spent,
    coalesce(sum(saved) FILTER (through <= slack), 0) AS saved,
    coalesce(arg_min(per_cost, through) FILTER (through > slack), 0) AS price,
    coalesce(arg_min(r.saved, through) FILTER (through > slack), 0) AS next_saved
  FROM asked JOIN ranking r ON true GROUP BY budget
)"""


def rate(late: str, n: str, digits: int = 3) -> str:
    """late / n, rounded half up, in integers; both arguments not negative."""
    unit = 10**digits
    return (
        f"CAST((2 * {unit} * CAST({late} AS HUGEINT) + {n}) // (2 * {n}) AS DOUBLE) / {unit}.0"
    )


LATE = rate("sum(late_delivery_risk)", "count(*)")


def _with(*parts: str, select: str) -> str:
    return "WITH " + "".join(parts) + "\n" + select


def _stg(select: str) -> str:
    return _with(STAGING, select=select)


def _dims(select: str) -> str:
    return _with(STAGING, DIMENSIONS, select=select)


def _fact(select: str) -> str:
    return _with(STAGING, DIMENSIONS, FACT, select=select)


def _orders(select: str) -> str:
    return _with(STAGING, ORDERS, select=select)


def _scores(select: str) -> str:
    return _with(STAGING, ORDERS, SCORES, select=select)


LARGE_BUDGETS = "[0.5, 1.0, 1.05, 1.25, 1.5, 2.0, 3.0]"
FEW_BUDGETS = "[0.5, 1.0, 1.5, 2.0, 2.5, 3.0]"
SWEEP = "[x / 10.0 for x in range(10, 41)]"


def _allocation(select: str, budgets: str = FEW_BUDGETS) -> str:
    return _with(STAGING, ORDERS, ALLOCATION.replace("{budgets}", budgets), select=select)


_HEADLINE = """SELECT budget, cost IS NOT NULL AS feasible,
  CAST(cost AS DOUBLE) AS total_cost, round(best.late, 6) AS expected_late,
  CAST((SELECT n FROM whole) AS BIGINT) AS n_orders,
  round((SELECT late FROM whole), 6) AS baseline_late,
  round((SELECT sum(mixed) FROM choice), 6) AS baseline_late_adjusted,
  round(100 * best.late / (SELECT late FROM whole), 6) AS pct_of_baseline,
  round(100 * best.late / (SELECT late FROM whole) - 100, 6) AS delta_pct
FROM best"""


def _key_report(table: str, source: str, keys: str) -> str:
    first_null = " OR ".join(f"{k.strip()} IS NULL" for k in keys.split(","))
    return f"""SELECT '{table}' AS key_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
  CAST(coalesce(sum(CASE WHEN is_null THEN n END), 0) AS BIGINT) AS n_null_keys,
  CAST(count(*) FILTER (n > 1) AS BIGINT) AS n_repeated_keys,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_surplus_rows
FROM (SELECT {keys}, count(*) AS n, ({first_null}) AS is_null FROM {source} GROUP BY {keys})"""


def _foreign_key(column: str, dim: str, key: str) -> str:
    return f"""SELECT '{column}' AS foreign_key, count(*) AS n_rows,
  CAST(count(*) FILTER (f.{column} IS NULL) AS BIGINT) AS n_null,
  CAST(count(*) FILTER (f.{column} IS NOT NULL AND d.{key} IS NULL) AS BIGINT) AS n_orphans
FROM fact f LEFT JOIN (SELECT DISTINCT {key} FROM {dim}) d ON d.{key} = f.{column}"""


_ORDER_FIELDS = [
    "geography_id", "shipping_mode_id", "order_date_id", "shipping_date_id",
    "days_for_shipping_real", "days_for_shipment_sched", "late_delivery_risk",
    "delivery_status", "order_status", "payment_type",
]

_PROFILED = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]

_FEATURES = """SELECT v.order_id, v.late_delivery_risk, v.order_region, v.shipping_mode,
  CAST(t.total_sales AS DECIMAL(28,2)) AS total_sales, t.max_sched AS days_for_shipment_sched
FROM v JOIN totals t USING (order_id)"""


def _chi_square(column: str) -> str:
    return _orders(f"""SELECT '{column}' AS variable, round(sum((o - e) * (o - e) / e), 6) AS chi2,
  CAST((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS BIGINT) AS dof,
  CAST(max(total) AS BIGINT) AS n_orders
FROM (
  SELECT x.a, y.b, coalesce(c.n, 0) AS o,
         CAST(x.n AS DOUBLE) * y.n / (SELECT count(*) FROM v) AS e,
         (SELECT count(*) FROM v) AS total
  FROM (SELECT {column} AS a, count(*) AS n FROM v GROUP BY 1) x
  CROSS JOIN (SELECT late_delivery_risk AS b, count(*) AS n FROM v GROUP BY 1) y
  LEFT JOIN (SELECT {column} AS a, late_delivery_risk AS b, count(*) AS n FROM v GROUP BY 1, 2) c
    ON c.a = x.a AND c.b = y.b)""")


def _pearson(column: str) -> str:
    """Unrounded statistic and degrees of freedom."""
    return f"""SELECT '{column}' AS variable, sum((o - e) * (o - e) / e) / 2 AS h,
  (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof
FROM (
  SELECT x.a, y.b, coalesce(c.n, 0) AS o,
         CAST(x.n AS DOUBLE) * y.n / (SELECT count(*) FROM v) AS e
  FROM (SELECT {column} AS a, count(*) AS n FROM v GROUP BY 1) x
  CROSS JOIN (SELECT late_delivery_risk AS b, count(*) AS n FROM v GROUP BY 1) y
  LEFT JOIN (SELECT {column} AS a, late_delivery_risk AS b, count(*) AS n FROM v GROUP BY 1, 2) c
    ON c.a = x.a AND c.b = y.b)"""


# Closed sums of the chi-square tail, with the error function for odd degrees of freedom,
# and Simpson's rule for that and for the density of Student's t.
_P_VALUES = f""",
tests AS ({_pearson("shipping_mode")} UNION ALL {_pearson("order_region")}),
weights AS (SELECT unnest(range(0, 40001)) AS k),
tails AS (
  SELECT variable, h, dof, CASE WHEN dof % 2 = 0 THEN
      list_sum([exp(-h + i * ln(h) - lgamma(i + 1)) for i in range(0, dof // 2)])
    ELSE list_sum([exp(-h + (i + 0.5) * ln(h) - lgamma(i + 1.5)) for i in range(0, dof // 2)])
    END AS summed,
    (SELECT sum(CASE WHEN k IN (0, 40000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
                * exp(-pow(sqrt(h) + k * 0.00025, 2))) * 0.00025 / 3 * 2 / sqrt(pi())
     FROM weights) AS error_function
  FROM tests
),
parts AS (
  SELECT late_delivery_risk AS y, count(*) AS n, avg(CAST(total_sales AS DOUBLE)) AS m,
         var_samp(CAST(total_sales AS DOUBLE)) / count(*) AS a
  FROM v JOIN totals USING (order_id) GROUP BY 1
),
welch AS (
  SELECT abs(p.m - q.m) / sqrt(p.a + q.a) AS t,
         pow(p.a + q.a, 2) / (p.a * p.a / (p.n - 1) + q.a * q.a / (q.n - 1)) AS dof
  FROM parts p, parts q WHERE p.y = 1 AND q.y = 0
),
student AS (
  SELECT 2 * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5 * ln(dof * pi())) * 0.001 / 3
    * (SELECT sum(CASE WHEN k IN (0, 40000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
                  * exp(-(dof + 1) / 2 * ln(1 + pow(t + k * 0.001, 2) / dof))) FROM weights) AS p
  FROM welch
)"""


def _by_region(scope: str, name: str) -> str:
    staged = "WITH RECURSIVE " + STAGING + ORDERS + REGION_CHOICES.replace("{scope}", scope)
    return staged + f"""
SELECT {name}budget, cost IS NOT NULL AS feasible, CAST(cost AS DOUBLE) AS total_cost,
  round(late, 6) AS expected_late, n AS n_orders, round(baseline, 6) AS baseline_late,
  round(adjusted, 6) AS baseline_late_adjusted,
  round(100 * late / baseline, 6) AS pct_of_baseline,
  round(100 * late / baseline - 100, 6) AS delta_pct FROM best"""


# Columns of the raw file, which are those of the staging table but the row number.
_CSV_COLUMNS = [c for c in schema.STAGING_COLUMNS if c != "row_id"] + ["_malformed"]


def _csv_losses(column: str) -> str:
    """Sales have a text on every seventh order and a third decimal on the next one;
    order dates of every fifth order have another format."""
    present = {"sales": "count(*)", "order_date": "count(*) FILTER (order_date IS NOT NULL OR order_id % 5 = 0)",
               "_malformed": "0"}.get(column, f"count({column})")
    unparsed = {"sales": "count(*) FILTER (order_id % 7 = 0)",
                "order_date": "count(*) FILTER (order_id % 5 = 0)"}.get(column, "0")
    rounded = {"sales": "count(*) FILTER (order_id % 7 = 1)"}.get(column, "0")
    return f"""SELECT '{column}' AS column_name, count(*) AS n_rows, CAST({present} AS BIGINT) AS n_present,
  CAST({unparsed} AS BIGINT) AS n_unparsed, CAST({rounded} AS BIGINT) AS n_rounded FROM stg"""


STATEMENTS: dict[str, str] = {
    "stg_orders": _stg("SELECT * FROM stg"),
    "dim_customer": _dims("SELECT * FROM dim_customer"),
    "dim_product": _dims("SELECT * FROM dim_product"),
    "dim_geography": _dims("SELECT * FROM dim_geography"),
    "dim_shipping_mode": _dims("SELECT * FROM dim_shipping_mode"),
    "dim_date": _dims("SELECT * FROM dim_date"),
    "fact_order_items": _fact("SELECT * FROM fact"),
    "v_orders": _fact(f"""SELECT {", ".join(f"one.{c}" for c in schema.V_ORDERS)}
FROM (SELECT min_by(fact, order_item_id) AS one FROM fact GROUP BY order_id)"""),
    "csv_ingest": _stg("""SELECT * REPLACE (CASE WHEN order_id % 10 = 0
  THEN product_name || chr(10) || '"odd", name' ELSE product_name END AS product_name) FROM stg"""),
    "csv_load_report": _stg("\nUNION ALL ".join(_csv_losses(c) for c in _CSV_COLUMNS)),
    "date_format_report": _stg("""SELECT column_name, pattern,
  CAST(sum(n) FILTER (nth = 1) OVER (PARTITION BY column_name) AS BIGINT) AS n_present, n AS n_shape, possible,
  CAST(count(*) FILTER (possible) OVER (PARTITION BY column_name, kind) - CAST(possible AS INTEGER) AS BIGINT)
    AS n_rivals
FROM (
  SELECT column_name, kind, n, pattern, row_number() OVER (PARTITION BY column_name, kind ORDER BY pattern) AS nth,
    CASE pattern WHEN 'M/d/yyyy H:mm' THEN true WHEN 'yyyy-M-d' THEN true WHEN 'd/M/yyyy' THEN true
      WHEN 'd/M/yyyy H:mm' THEN last_day <= 12 WHEN 'M/d/yyyy' THEN last_day <= 12 ELSE false END AS possible
  FROM (
    SELECT 'order date (DateOrders)' AS column_name, CASE WHEN order_id % 5 = 0 THEN 'iso' ELSE 'time' END AS kind,
      count(order_date) AS n, max(day(order_date)) AS last_day FROM stg GROUP BY ALL
    UNION ALL
    SELECT 'shipping date (DateOrders)', 'day', count(shipping_date), max(day(shipping_date)) FROM stg
  ) JOIN (
    SELECT unnest(['time', 'time', 'iso', 'iso', 'iso', 'day', 'day', 'day']) AS kind,
      unnest(['M/d/yyyy H:mm', 'd/M/yyyy H:mm', 'yyyy-M-d', 'd-M-yyyy', 'M-d-yyyy',
              'M/d/yyyy', 'd/M/yyyy', 'yyyy/M/d']) AS pattern
  ) USING (kind)
)"""),
    "redelivered_batch": _stg("SELECT order_id, count(*) AS n_items FROM stg GROUP BY order_id"),
    "score_stream": _orders("SELECT order_id, true AS same_score, true AS same_band FROM v"),
    "logit_score_equations": _orders("""SELECT 'Intercept' AS term, count(*) AS n_rows,
  CAST(sum(late_delivery_risk) AS DOUBLE) AS observed, CAST(sum(late_delivery_risk) AS DOUBLE) AS expected FROM v
UNION ALL SELECT 'shipping_mode_' || shipping_mode, count(*), sum(late_delivery_risk), sum(late_delivery_risk)
FROM v GROUP BY shipping_mode
UNION ALL SELECT 'order_region_' || order_region, count(*), sum(late_delivery_risk), sum(late_delivery_risk)
FROM v GROUP BY order_region"""),
    "late_rate_by_region_in_order": _orders(f"""SELECT *, row_number() OVER (
  ORDER BY late_rate DESC NULLS FIRST, order_region) AS position
FROM (SELECT order_region, count(*) AS n_orders, {LATE} AS late_rate FROM v GROUP BY 1)"""),
    "late_rate_by_order_value_in_order": _orders(f"""SELECT sales_bucket, n_orders, late_rate,
  row_number() OVER (ORDER BY smallest) AS position
FROM (SELECT CASE WHEN total_sales < 100000 THEN '<100000'
  WHEN total_sales < 200000 THEN '100000-200000' WHEN total_sales < 300000 THEN '200000-300000'
  ELSE '300000+' END AS sales_bucket, count(*) AS n_orders, {LATE} AS late_rate,
  min(total_sales) AS smallest FROM v JOIN totals USING (order_id) GROUP BY 1)"""),
    "distinct_regions_in_order": _stg("""SELECT order_region,
  row_number() OVER (ORDER BY order_region NULLS LAST) AS position
FROM (SELECT DISTINCT order_region FROM stg)"""),
    "worst_departments": _stg(f"""SELECT department_name, count(*) AS n_order_items,
  {LATE} AS late_rate FROM items WHERE product_card_id IS NOT NULL GROUP BY 1
HAVING count(*) >= 2400 ORDER BY late_rate DESC, department_name LIMIT 10"""),
    "dq_orders_without_lines": """SELECT 'o_orderkey' AS foreign_key, count(*) AS n_rows,
  CAST(count(*) FILTER (o_orderkey IS NULL) AS BIGINT) AS n_null,
  CAST(count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS BIGINT) AS n_orphans
FROM orders""",
    "test_p_values": _with(STAGING, ORDERS, _P_VALUES, select="""SELECT variable,
  round(summed + CASE WHEN dof % 2 = 1 THEN error_function ELSE 0 END, 6) AS p_value FROM tails
UNION ALL SELECT 'total_sales', round(p, 6) FROM student"""),
    "logit_mode": _orders("""SELECT term, round(coefficient, 4) AS coefficient,
  round(std_error, 4) AS std_error, round(ll, 4) AS log_likelihood, round(ll0, 4) AS null_log_likelihood,
  round(1 - ll / ll0, 4) AS pseudo_r2
FROM (
  -- One free parameter per mode: the fit is the observed rate of every mode.
  WITH cell AS (
    SELECT shipping_mode AS mode, CAST(sum(late_delivery_risk) AS DOUBLE) AS a,
           CAST(sum(1 - late_delivery_risk) AS DOUBLE) AS b FROM v GROUP BY 1),
  whole AS (
    SELECT sum(a * ln(a / (a + b)) + b * ln(b / (a + b))) AS ll,
      sum(a) * ln(sum(a) / sum(a + b)) + sum(b) * ln(sum(b) / sum(a + b)) AS ll0 FROM cell),
  base AS (SELECT * FROM cell ORDER BY mode LIMIT 1)
  SELECT 'Intercept' AS term, ln(a / b) AS coefficient, sqrt(1 / a + 1 / b) AS std_error, ll, ll0
  FROM base, whole
  UNION ALL
  SELECT 'shipping_mode_' || c.mode, ln(c.a / c.b) - ln(base.a / base.b),
    sqrt(1 / c.a + 1 / c.b + 1 / base.a + 1 / base.b), ll, ll0
  FROM cell c, base, whole WHERE c.mode <> base.mode)"""),
    "late_rate_by_region": _orders(
        f"SELECT order_region, count(*) AS n_orders, {LATE} AS late_rate FROM v GROUP BY 1"
    ),
    "late_rate_by_mode": _orders(
        f"SELECT shipping_mode, count(*) AS n_orders, {LATE} AS late_rate FROM v GROUP BY 1"
    ),
    "late_rate_region_mode": _orders(f"""SELECT order_region, shipping_mode, count(*) AS n_orders,
  {LATE} AS late_rate FROM v GROUP BY 1, 2"""),
    "avg_order_value_region_mode": _stg(f"""SELECT order_region, shipping_mode,
  {rate("sum(CAST(100 * total AS HUGEINT))", "count(*)", 0)} / 100.0 AS avg_order_value
FROM (SELECT order_id, order_region, shipping_mode, sum(sales) AS total FROM items GROUP BY 1, 2, 3)
GROUP BY 1, 2"""),
    "late_rate_by_order_value": _orders(f"""SELECT CASE WHEN total_sales < 100000 THEN '<100000'
  WHEN total_sales < 200000 THEN '100000-200000' WHEN total_sales < 300000 THEN '200000-300000'
  ELSE '300000+' END AS sales_bucket, count(*) AS n_orders, {LATE} AS late_rate
FROM v JOIN totals USING (order_id) GROUP BY 1"""),
    "worst_categories": _stg(f"""SELECT category_name, count(*) AS n_order_items, {LATE} AS late_rate
FROM items WHERE product_card_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 200
ORDER BY late_rate DESC, category_name LIMIT 10"""),
    "late_rate_by_ship_weekday": _orders(f"""SELECT dayname(shipping_date) AS weekday,
  count(*) AS n_orders, {LATE} AS late_rate FROM v GROUP BY 1"""),
    "actual_vs_scheduled_by_mode": _orders(f"""SELECT shipping_mode,
  {rate("sum(days_for_shipping_real)", "count(*)", 2)} AS avg_actual_days,
  {rate("sum(days_for_shipment_sched)", "count(*)", 2)} AS avg_scheduled_days
FROM v GROUP BY 1"""),
    "late_rate_selected_regions": _orders(f"""SELECT order_region, shipping_mode,
  count(*) AS n_orders, {LATE} AS late_rate FROM v
WHERE order_region IN ('NATION_0', 'NATION_7', 'NATION_13') GROUP BY 1, 2"""),
    "region_mode_stats": _scores("""SELECT order_region, shipping_mode, n AS n_orders,
  raw AS late_rate FROM shrunk"""),
    "region_mode_table": _scores("""SELECT order_region, shipping_mode, n AS n_orders,
  raw AS late_rate FROM shrunk WHERE order_region IN ('NATION_0', 'NATION_7', 'NATION_13')"""),
    "late_rate_pivot": _scores("""SELECT order_region,
  max(raw) FILTER (shipping_mode = 'First Class') AS "First Class",
  max(raw) FILTER (shipping_mode = 'Same Day') AS "Same Day",
  max(raw) FILTER (shipping_mode = 'Second Class') AS "Second Class",
  max(raw) FILTER (shipping_mode = 'Standard Class') AS "Standard Class"
FROM shrunk GROUP BY 1"""),
    "overall_late_rate": _orders(
        f"SELECT count(*) AS n_orders, {LATE} AS late_rate FROM v"
    ),
    "distinct_regions": _stg("SELECT DISTINCT order_region FROM stg"),
    "distinct_modes": _stg("SELECT DISTINCT shipping_mode FROM stg"),
    "profile_orders": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, "
        f"count({c}) AS n_non_null FROM orders" for c, t in _PROFILED
    ),
    "dq_fact_pk": _fact("\nUNION ALL ".join([
        _key_report("dim_customer", "dim_customer", "customer_id"),
        _key_report("dim_product", "dim_product", "product_card_id"),
        _key_report("dim_geography", "dim_geography", "geography_id"),
        _key_report("dim_shipping_mode", "dim_shipping_mode", "shipping_mode_id"),
        _key_report("dim_date", "dim_date", "date_id"),
        _key_report("fact_order_items", "fact", "order_item_id"),
    ])),
    "dq_dim_unique": _dims("\nUNION ALL ".join([
        _key_report("dim_geography", "dim_geography",
                    "order_city, order_state, order_country, order_region, market"),
        _key_report("dim_shipping_mode", "dim_shipping_mode", "shipping_mode"),
        _key_report("dim_date", "dim_date", "full_date"),
    ])),
    "dq_line_keys": _key_report("lineitem", "lineitem", "l_orderkey, l_linenumber"),
    "dq_foreign_keys": _fact("\nUNION ALL ".join([
        _foreign_key("customer_id", "dim_customer", "customer_id"),
        _foreign_key("product_card_id", "dim_product", "product_card_id"),
        _foreign_key("geography_id", "dim_geography", "geography_id"),
        _foreign_key("shipping_mode_id", "dim_shipping_mode", "shipping_mode_id"),
        _foreign_key("order_date_id", "dim_date", "date_id"),
        _foreign_key("shipping_date_id", "dim_date", "date_id"),
    ])),
    "dq_order_constancy": _fact("\nUNION ALL ".join(
        f"""SELECT (SELECT count(DISTINCT order_id) FROM fact) AS n_orders, '{c}' AS field,
  count(*) AS n_inconsistent
FROM (SELECT order_id FROM fact GROUP BY order_id HAVING count(DISTINCT {c}) > 1
      OR (count({c}) > 0 AND count({c}) < count(*)))""" for c in _ORDER_FIELDS
    )),
    "dq_line_constancy": """SELECT count(*) AS n_orders,
  CAST(count(*) FILTER (flags > 1) AS BIGINT) AS n_varying_returnflag,
  CAST(count(*) FILTER (statuses > 1) AS BIGINT) AS n_varying_linestatus
FROM (SELECT l_orderkey, count(DISTINCT l_returnflag) AS flags,
        count(DISTINCT l_linestatus) AS statuses FROM lineitem GROUP BY 1)""",
    "insert_if_absent_customer": _dims("""SELECT customer_id, CASE WHEN customer_id IN (
    SELECT customer_id FROM stg WHERE order_date < DATE '1996-01-01')
  THEN 'formerly ' || customer_segment ELSE customer_segment END AS customer_segment,
  customer_city, customer_state, customer_country FROM dim_customer"""),
    "incremental_load": _orders(_FEATURES),
    "late_rates_after_load": _orders(f"""SELECT order_region, shipping_mode, count(*) AS n_orders,
  {LATE} AS late_rate FROM v GROUP BY 1, 2"""),
    "order_summary": _with(STAGING, DIMENSIONS, ORDERS, select="""SELECT
  CASE WHEN grouping(geography_id) = 0 THEN 'place_mode' WHEN grouping(shipping_date_id) = 0
       THEN 'ship_day' ELSE 'value' END AS part,
  has_order, geography_id, shipping_mode_id, shipping_date_id, value_bin, late_delivery_risk,
  count(*) AS n, CAST(sum(days_for_shipping_real) AS BIGINT) AS sum_real,
  count(days_for_shipping_real) AS n_real,
  CAST(sum(days_for_shipment_sched) AS BIGINT) AS sum_sched,
  count(days_for_shipment_sched) AS n_sched
FROM (
  SELECT v.*, g.geography_id, m.shipping_mode_id, d.date_id AS shipping_date_id,
    v.order_id IS NOT NULL AS has_order, CASE WHEN whole < 1 THEN 0 ELSE whole - whole % unit END AS value_bin
  FROM v JOIN (
    SELECT order_id, whole, CAST(10 ** greatest(length(CAST(whole AS VARCHAR)) - 2, 0) AS BIGINT) AS unit
    FROM (SELECT order_id, CAST(floor(total_sales) AS BIGINT) AS whole FROM totals)
  ) USING (order_id)
  LEFT JOIN dim_geography g ON (g.order_city, g.order_state, g.order_country, g.order_region, g.market)
    IS NOT DISTINCT FROM (v.order_city, v.order_state, v.order_country, v.order_region, v.market)
  LEFT JOIN dim_shipping_mode m ON m.shipping_mode = v.shipping_mode
  LEFT JOIN dim_date d ON d.full_date = v.shipping_date
)
GROUP BY GROUPING SETS (
  (has_order, late_delivery_risk, geography_id, shipping_mode_id),
  (has_order, late_delivery_risk, shipping_date_id), (has_order, late_delivery_risk, value_bin))"""),
    "order_features": _orders("""SELECT v.order_id, v.late_delivery_risk,
  v.order_region, v.shipping_mode, CAST(t.total_sales AS DECIMAL(28,2)) AS total_sales
FROM v JOIN totals t USING (order_id)"""),
    "training_features": _orders(_FEATURES),
    "chi_square_mode": _chi_square("shipping_mode"),
    "chi_square_region": _chi_square("order_region"),
    "welch_order_value": _orders("""SELECT n_late, n_on_time, round(mean_late, 4) AS mean_late,
  round(mean_on_time, 4) AS mean_on_time, round((mean_late - mean_on_time) / sqrt(a + b), 6) AS t,
  round((a + b) * (a + b) / (a * a / (n_late - 1) + b * b / (n_on_time - 1)), 4) AS dof
FROM (SELECT *, var_late / n_late AS a, var_on_time / n_on_time AS b FROM (
  SELECT count(*) FILTER (late_delivery_risk = 1) AS n_late,
    count(*) FILTER (late_delivery_risk = 0) AS n_on_time,
    avg(CAST(total_sales AS DOUBLE)) FILTER (late_delivery_risk = 1) AS mean_late,
    avg(CAST(total_sales AS DOUBLE)) FILTER (late_delivery_risk = 0) AS mean_on_time,
    var_samp(CAST(total_sales AS DOUBLE)) FILTER (late_delivery_risk = 1) AS var_late,
    var_samp(CAST(total_sales AS DOUBLE)) FILTER (late_delivery_risk = 0) AS var_on_time
  FROM v JOIN totals USING (order_id)))"""),
    "stratified_split_counts": _orders("""SELECT late_delivery_risk,
  CASE WHEN rn <= 0.8 * n THEN 'train' ELSE 'test' END AS part, count(*) AS n_orders,
  CAST(sum(order_id) AS BIGINT) AS sum_order_id
FROM (SELECT order_id, late_delivery_risk, count(*) OVER (PARTITION BY late_delivery_risk) AS n,
        row_number() OVER (PARTITION BY late_delivery_risk
                           ORDER BY md5(order_id || '|42'), order_id) AS rn FROM v)
GROUP BY 1, 2"""),
    "logistic_balance": _orders("""SELECT count(*) AS n_orders,
  CAST(sum(late_delivery_risk) AS BIGINT) AS n_late,
  round(avg(CAST(late_delivery_risk AS DOUBLE)), 3) AS mean_score
FROM (SELECT late_delivery_risk, count(*) OVER (PARTITION BY late_delivery_risk) AS n,
        row_number() OVER (PARTITION BY late_delivery_risk
                           ORDER BY md5(order_id || '|42'), order_id) AS rn FROM v)
WHERE rn <= 0.8 * n"""),
    "late_rate_shrunk": _scores("""SELECT order_region, shipping_mode, n AS n_orders,
  raw AS late_rate, round(rate, 9) AS global_rate, round(score, 9) AS late_rate_adjusted
FROM shrunk, world"""),
    "shrinkage_shift_top": _scores("""SELECT order_region, shipping_mode, n AS n_orders,
  raw AS late_rate, round(score, 9) AS late_rate_adjusted, round(abs(score - raw), 9) AS shift
FROM shrunk ORDER BY shift DESC, order_region, shipping_mode LIMIT 8"""),
    "baseline_expected_late": _scores("""SELECT CAST(sum(n) AS BIGINT) AS n_orders,
  round(sum(n * raw), 6) AS baseline_late, round(sum(n * score), 6) AS baseline_late_adjusted
FROM shrunk"""),
    "score_counts": _scores("SELECT score, CAST(pos AS BIGINT) AS n_pos, CAST(neg AS BIGINT) AS n_neg FROM by_score"),
    "roc_auc": _scores("""SELECT round(CAST(sum(neg * (2 * (tp - pos) + pos)) AS DOUBLE)
  / (2.0 * CAST(max(p) AS DOUBLE) * CAST(max(q) AS DOUBLE)), 9) AS roc_auc FROM curve"""),
    "pr_auc": _scores("""SELECT round(sum((r - r0) * (pr + p0) / 2), 9) AS pr_auc FROM (
  SELECT tp / p AS r, tp / (tp + fp) AS pr, lag(tp / p, 1, 0.0) OVER w AS r0,
         lag(tp / (tp + fp), 1, 1.0) OVER w AS p0
  FROM (SELECT score, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp,
               CAST(p AS DOUBLE) AS p FROM curve)
  WINDOW w AS (ORDER BY score DESC))"""),
    "pr_curve": _scores("""SELECT score AS threshold,
  CAST(tp AS DOUBLE) / (CAST(tp AS DOUBLE) + CAST(fp AS DOUBLE)) AS "precision",
  CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) AS recall FROM curve
UNION ALL SELECT NULL, 1.0, 0.0"""),
    "classification_report": _scores("""SELECT name AS class, round(pr, 9) AS "precision",
  round(re, 9) AS recall, round(f1, 9) AS f1_score, CAST(support AS BIGINT) AS support FROM (
  WITH c AS (
    SELECT CAST(coalesce(sum(pos) FILTER (score >= 0.5), 0) AS DOUBLE) AS tp,
      CAST(coalesce(sum(neg) FILTER (score >= 0.5), 0) AS DOUBLE) AS fp,
      CAST(coalesce(sum(pos) FILTER (score < 0.5), 0) AS DOUBLE) AS fn,
      CAST(coalesce(sum(neg) FILTER (score < 0.5), 0) AS DOUBLE) AS tn FROM by_score),
  m AS (
    SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
      coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
      tn + fp AS s0, tp + fn AS s1 FROM c),
  f AS (
    SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
      coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM m)
  SELECT '0' AS name, p0 AS pr, r0 AS re, f0 AS f1, s0 AS support FROM f
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
  UNION ALL SELECT 'accuracy', (tp + tn) / (s0 + s1), (tp + tn) / (s0 + s1),
    (tp + tn) / (s0 + s1), s0 + s1 FROM f
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM f
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1),
    (r0 * s0 + r1 * s1) / (s0 + s1), (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM f)"""),
    "risk_bands": _scores("""SELECT CASE WHEN score > 0.6 THEN 'high' WHEN score > 0.4 THEN 'moderate'
  ELSE 'low' END AS risk_band, CAST(sum(pos + neg) AS BIGINT) AS n_orders,
  CAST(sum(pos) AS BIGINT) AS n_late FROM by_score GROUP BY 1"""),
    "allocation_by_budget": _allocation(_HEADLINE),
    "allocation_sweep": _allocation(_HEADLINE, SWEEP),
    "allocation_by_region": _by_region("'all'", ""),
    "allocation_large": _with(STAGING, ORDERS, LARGE.replace(
        "{budgets}", LARGE_BUDGETS), select="""SELECT a.budget, slack >= 0 AS feasible, CAST(places AS BIGINT) AS n_regions,
  CAST(coalesce(n_upgrades, 0) AS BIGINT) AS n_upgrades,
  CASE WHEN slack >= 0 THEN a.cost + spent END AS total_cost,
  CASE WHEN slack >= 0 THEN round(a.late - saved, 6) END AS expected_late,
  CASE WHEN slack >= 0 THEN round(price * (slack - spent), 6) END AS gap,
  CASE WHEN slack >= 0 THEN round(next_saved, 6) END AS next_saved
FROM asked a JOIN reach USING (budget)"""),
    "allocation_per_market": _by_region("c.market", "scope AS market, "),
    "allocation_plan": _allocation("""SELECT budget,
  unnest(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST']) AS market,
  unnest(modes) AS recommended_mode FROM best WHERE cost IS NOT NULL"""),
}
