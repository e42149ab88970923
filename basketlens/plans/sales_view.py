"""The sales lines that the registered queries read: one row per line item of the given tables.

DuckDB reads them by ``SALES_SQL``. Spark gets the same rows by ``READ_SQL``, which names the joins in the order that moves
the fewest bytes: what a line item itself says is computed first, orders meet their customers before they meet the lines, and
what follows from a customer's number is computed from it after the last join.
"""

from basketlens import config
from basketlens.operators import features, quality, segment
from basketlens.sources.staging import materialize, spread, temporary

TABLES = ["lineitem", "orders", "customer", "part"]

SALES_SQL = """
SELECT l.l_orderkey AS receipt_id,
  CAST(l.l_linenumber AS INT) AS line_no,
  CAST(l.l_partkey AS DOUBLE) AS sku,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 23 = 0 THEN NULL ELSE l.l_quantity END AS units,
  CASE WHEN l.l_orderkey % 97 = 0 THEN CAST(1.5 AS DOUBLE) ELSE l.l_discount END AS discount_pct,
  CASE WHEN l.l_partkey % 10 = 0 THEN NULL
       WHEN (l.l_partkey + l.l_suppkey) % 211 = 0 THEN l.l_extendedprice * 20
       ELSE l.l_extendedprice * (1 - l.l_discount) END AS amount,
  CAST(l.l_suppkey % 10 AS DOUBLE) AS store,
  CASE WHEN c.c_custkey % 50 = 0 THEN CAST(9 AS DOUBLE) ELSE CAST(1 + c.c_custkey % 2 AS DOUBLE) END AS gender,
  CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE c.c_mktsegment END AS channel,
  l.l_linestatus AS status,
  p.p_name AS product,
  CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE concat('N', CAST(c.c_custkey % 100 AS STRING)) END AS first_name,
  concat('A', CAST(c.c_custkey % 50 AS STRING)) AS last_name,
  c.c_name AS customer_run,
  CASE WHEN c.c_custkey % 29 = 0 THEN 'sin-codigo'
       WHEN c.c_custkey % 3 = 0 THEN upper(c.uuid)
       ELSE c.uuid END AS customer_id,
  l.l_shipdate + CAST(l.l_linenumber * 3 + l.l_orderkey % 3 AS INT) * INTERVAL '1' HOUR AS ts,
  CASE WHEN c.c_custkey % 8 = 0 THEN NULL
       ELSE make_date(CAST(1920 + c.c_custkey % 90 AS INT), CAST(1 + c.c_custkey % 12 AS INT),
                      CAST(1 + c.c_custkey % 28 AS INT)) END AS birth_date
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN (SELECT c0.*, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4),
                             substr(h, 17, 4), substr(h, 21, 12)) AS uuid
      FROM (SELECT *, md5(CAST(c_custkey AS STRING)) AS h FROM customer) c0) c
  ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
"""

READ_SQL = """
SELECT receipt_id, line_no, CAST(l_partkey AS DOUBLE) AS sku, units, discount_pct, amount, store,
  CASE WHEN c_custkey % 50 = 0 THEN CAST(9 AS DOUBLE) ELSE CAST(1 + c_custkey % 2 AS DOUBLE) END AS gender,
  channel, status, product,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('N', CAST(c_custkey % 100 AS STRING)) END AS first_name,
  concat('A', CAST(c_custkey % 50 AS STRING)) AS last_name,
  customer_run,
  CASE WHEN c_custkey % 29 = 0 THEN 'sin-codigo'
       WHEN c_custkey % 3 = 0 THEN upper(uuid)
       ELSE uuid END AS customer_id,
  ts,
  CASE WHEN c_custkey % 8 = 0 THEN NULL
       ELSE make_date(CAST(1920 + c_custkey % 90 AS INT), CAST(1 + c_custkey % 12 AS INT),
                      CAST(1 + c_custkey % 28 AS INT)) END AS birth_date
FROM (
  SELECT *, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) AS uuid
  FROM (
    SELECT l.*, product, channel, c_custkey, customer_run, md5(CAST(c_custkey AS STRING)) AS h
    FROM (SELECT l_orderkey AS receipt_id, l_partkey, CAST(l_linenumber AS INT) AS line_no,
            CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN NULL ELSE l_quantity END AS units,
            CASE WHEN l_orderkey % 97 = 0 THEN CAST(1.5 AS DOUBLE) ELSE l_discount END AS discount_pct,
            CASE WHEN l_partkey % 10 = 0 THEN NULL
                 WHEN (l_partkey + l_suppkey) % 211 = 0 THEN l_extendedprice * 20
                 ELSE l_extendedprice * (1 - l_discount) END AS amount,
            CAST(l_suppkey % 10 AS DOUBLE) AS store,
            l_linestatus AS status,
            l_shipdate + CAST(l_linenumber * 3 + l_orderkey % 3 AS INT) * INTERVAL '1' HOUR AS ts
          FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL) l
    JOIN (SELECT p_partkey, p_name AS product FROM part) p ON l_partkey = p_partkey
    JOIN (SELECT o_orderkey, c_custkey, customer_run,
            CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE c_mktsegment END AS channel
          FROM orders
          JOIN (SELECT c_custkey, c_name AS customer_run, c_mktsegment FROM customer) c ON o_custkey = c_custkey) o
      ON receipt_id = o_orderkey))
"""


def sales(spark, sf_dir):
    """Raw sales lines. Small sides are broadcast by their measured size, others shuffle."""
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    frames["lineitem"] = spread(frames["lineitem"])
    query = READ_SQL
    for t in TABLES:
        query = query.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(query, **frames)


def valid(spark, sf_dir):
    return quality.validate_base(sales(spark, sf_dir))


def derived(spark, sf_dir, *only):
    """Validated lines with the wanted derived columns (default: all), validated too."""
    lines = valid(spark, sf_dir)
    if not only or {"amount_segment", "purchase_freq"} & set(only):
        lines = staged(lines)
    return quality.validate_derived(features.derive_features(lines, only or config.DERIVED))


def staged(frame, *columns, compact=False):
    """The wanted columns, written once: for operators that pass over the joined view several times."""
    return materialize(frame.select(*columns) if columns else frame, compact)


def staged_derived(spark, sf_dir, *columns):
    """The wanted columns of the derived lines, written once. Of the validated lines only what these need is written, and deleted then."""
    needed = dict.fromkeys([*[c for c in columns if c not in config.DERIVED], *features.needed_for(config.DERIVED)])
    with temporary(spark) as keep:
        lines = staged(valid(spark, sf_dir), *needed, compact=True)
        return keep(staged(quality.validate_derived(features.derive_features(lines)), *columns, compact=True))


def customers(spark, sf_dir):
    """Recency comes from the customers' latest lines, which the customer table keeps: the join runs once."""
    return segment.customer_table(derived(spark, sf_dir, "amount_per_unit", "age"))


# ---- the same frames for the SQL check --------------------------------------------------

def _divide(a, b):
    return (f"CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN ({a}) < 0 THEN CAST('-Infinity' AS DOUBLE) END ELSE ({a}) / nullif({b}, 0) END")


VALID_SQL = """
SELECT * REPLACE (
  CASE WHEN discount_pct BETWEEN 0 AND 1 THEN discount_pct END AS discount_pct,
  CASE WHEN gender IN (1, 2) THEN gender END AS gender,
  CASE WHEN regexp_full_match(lower(customer_id), '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}')
       THEN lower(customer_id) END AS customer_id)
FROM sales
"""

FEATURES_SQL = f"""
SELECT v.*,
  {_divide('v.amount', 'v.units')} AS amount_per_unit,
  2026 - year(v.birth_date) AS age,
  hour(v.ts) AS hour,
  f.purchase_freq,
  date_sub('day', v.ts, m.max_ts) AS recency_days,
  coalesce(isodow(v.ts) >= 6, false) AS is_weekend,
  CASE WHEN v.amount > m.p66 THEN 'Alto' WHEN v.amount > m.p33 THEN 'Medio' ELSE 'Bajo' END AS amount_segment,
  {_divide('v.amount', '1 - v.discount_pct')} AS gross_amount
FROM valid v
CROSS JOIN (SELECT max(ts) AS max_ts, quantile_cont(amount, 0.33) AS p33, quantile_cont(amount, 0.66) AS p66
            FROM valid) m
LEFT JOIN (SELECT customer_id, count(receipt_id) AS purchase_freq FROM valid
           WHERE customer_id IS NOT NULL GROUP BY customer_id) f ON v.customer_id = f.customer_id
"""

DERIVED_SQL = """
SELECT * REPLACE (
  CAST(amount_per_unit AS DOUBLE) AS amount_per_unit,
  CASE WHEN age BETWEEN 12 AND 100 THEN CAST(age AS DOUBLE) END AS age,
  CAST(hour AS DOUBLE) AS hour,
  CASE WHEN purchase_freq >= 1 THEN CAST(purchase_freq AS DOUBLE) ELSE 1.0::DOUBLE END AS purchase_freq,
  CAST(recency_days AS DOUBLE) AS recency_days,
  CASE WHEN gross_amount >= 0 THEN gross_amount END AS gross_amount)
FROM features
"""

CUSTOMERS_SQL = """
SELECT customer_id, avg(amount) AS amount_mean, coalesce(sum(amount), 0) AS amount_sum,
  avg(discount_pct) AS discount_mean, avg(age) AS age_mean, min(recency_days) AS recency_min,
  avg(amount_per_unit) AS amount_per_unit_mean, count(*) AS purchase_count
FROM derived WHERE customer_id IS NOT NULL GROUP BY customer_id
"""

LAYERS = {"sales": SALES_SQL, "valid": VALID_SQL, "features": FEATURES_SQL, "derived": DERIVED_SQL,
          "customers": CUSTOMERS_SQL}


def oracle(upto, body):
    """A self-contained statement: the layers up to the named one, then the body.

    The body may open with more named layers, written as ``name AS (…), … SELECT``.
    """
    names = list(LAYERS)[:list(LAYERS).index(upto) + 1]
    head = ", ".join(f"{n} AS ({LAYERS[n]})" for n in names)
    body = body.strip()
    joint = " " if body.upper().startswith("SELECT") else ", "
    return f"WITH {head}{joint}{body}"
