"""Independent SQL formulations of the query catalogue, for DuckDB.

The fixture bindings are repeated here as SQL common table expressions over the raw
test tables (region nation customer part orders lineitem events), and every query is
written the plain relational way (outer joins, UNION ALL, FILTER, QUALIFY) rather
than mirroring the Spark plan. Dates derived from ``as_of`` are computed in Python and
inlined as literals.
"""

from __future__ import annotations

import datetime as dt

from branchlens.plans import catalog as Q
from branchlens.sources import fixtures as fx


def _d(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def _m(d: dt.date) -> str:
    return f"'{d.strftime('%Y-%m')}'"


def _prev_month(d: dt.date) -> dt.date:
    return d.replace(day=1) - dt.timedelta(days=1)


CANCELED = "CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false ELSE NULL END"
LIVE = "canceled IS DISTINCT FROM true"


def r2(x: str) -> str:
    return f"(round_even(({x}) * 100.0, 0) / 100.0)"


def title(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform("
            f"regexp_extract_all(lower({x}), '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda t: upper(substr(t, 1, 1)) || substr(t, 2)), '') END")


def currency(x: str) -> str:
    cleaned = f"trim(replace(replace(replace({x}, 'AR$', ''), '.', ''), ',', '.'))"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE coalesce(TRY_CAST({cleaned} AS DOUBLE), 0.0) END"


def coerce_int(x: str) -> str:
    return f"coalesce(TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER), 0)"


def trunc_name(x: str) -> str:
    return f"CASE WHEN length({x}) > 20 THEN substr({x}, 1, 20) || '...' ELSE {x} END"


def comma_money(x: str) -> str:
    return f"'AR$ ' || replace(CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"


FIXTURES = f"""
nb AS (SELECT n.n_nationkey, r.r_name AS branch FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
cb AS (SELECT c.c_custkey, c.c_name, c.c_acctbal, nb.branch FROM customer c LEFT JOIN nb ON c.c_nationkey = nb.n_nationkey),
ob AS (SELECT o.*, cb.c_name, cb.c_acctbal, cb.branch FROM orders o LEFT JOIN cb ON o.o_custkey = cb.c_custkey),
lb AS (SELECT l.*, ob.branch FROM lineitem l LEFT JOIN ob ON l.l_orderkey = ob.o_orderkey),
fx_sales AS (
  SELECT CAST(ob.o_orderkey AS VARCHAR) AS sale_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
         o_orderpriority AS sale_type, o_orderdate AS created_at, cl.closed_at,
         CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id, branch
  FROM ob LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS closed_at FROM lineitem GROUP BY l_orderkey) cl
    ON ob.o_orderkey = cl.l_orderkey),
fx_lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sale_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
         {CANCELED} AS canceled, branch, l_linenumber AS line_number, l_shipdate AS ship_date
  FROM lb),
fx_payments AS (
  SELECT CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS amount,
         l_shipdate AS created_at, l_linestatus AS method, {CANCELED} AS canceled, branch
  FROM lb),
fx_payments_ev AS (
  SELECT CAST(event_id AS VARCHAR) AS payment_id, CAST(value AS DECIMAL(18,2)) AS amount, ts AS created_at,
         event_type AS method, (event_type = 'error') AS canceled, 'B' || CAST(user_id % 3 AS VARCHAR) AS branch
  FROM events),
fx_catalog AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, concat_ws(' ', p_name, p_brand, p_type) AS product_name,
         CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_type END AS product_category, r.r_name AS branch
  FROM part, region r),
fx_known_pairs AS (
  SELECT DISTINCT {trunc_name("concat_ws(' ', p_name, p_brand, p_type)")} AS product, p_type AS category
  FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 40 <> 0),
fx_bookings AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS event_date,
         upper(c_name) AS client, branch, o_orderpriority AS menu,
         CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE CAST(o_orderkey % 60 AS VARCHAR) END AS guests,
         'turno ' || CAST(o_orderkey % 3 AS VARCHAR) AS slot,
         {comma_money("c_acctbal")} AS price_per_guest,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '-'
              ELSE {comma_money("o_totalprice")} END AS total,
         CASE WHEN o_orderstatus = 'F' THEN 'Ganado' ELSE 'Perdido' END AS status
  FROM ob),
lines_enriched AS (
  SELECT l.sale_id, l.product_id, l.branch, l.price, l.quantity, s.created_at, s.closed_at, s.sale_type,
         CAST(s.created_at AS DATE) AS day, strftime(s.created_at, '%Y-%m') AS month,
         c.product_name, c.product_category
  FROM (SELECT * FROM fx_lines WHERE {LIVE}) l
  LEFT JOIN fx_sales s ON l.sale_id = s.sale_id AND l.branch IS NOT DISTINCT FROM s.branch
  LEFT JOIN (SELECT product_id, branch, {trunc_name("product_name")} AS product_name, product_category
             FROM fx_catalog WHERE CAST(product_id AS BIGINT) % 50 <> 0) c
    ON l.product_id = c.product_id AND l.branch IS NOT DISTINCT FROM c.branch),
payments_live AS (
  SELECT *, CAST(created_at AS DATE) AS day, strftime(created_at, '%Y-%m') AS month
  FROM fx_payments WHERE {LIVE}),
product_daily AS (
  SELECT branch, day, product_name AS product, sum(quantity) AS qty, sum(price) AS revenue
  FROM lines_enriched WHERE branch IS NOT NULL AND day IS NOT NULL AND product_name IS NOT NULL
  GROUP BY branch, day, product_name HAVING sum(quantity) > 0),
category_daily AS (
  SELECT branch, day, product_category AS category, sum(quantity) AS qty, sum(price) AS revenue
  FROM lines_enriched WHERE branch IS NOT NULL AND day IS NOT NULL AND product_category IS NOT NULL
  GROUP BY branch, day, product_category HAVING sum(quantity) > 0),
pairs AS (
  SELECT DISTINCT product_name AS product, product_category AS category FROM lines_enriched
  WHERE product_name IS NOT NULL AND product_category IS NOT NULL),
bookings_clean AS (
  SELECT strftime(try_strptime(event_date, '%d/%m/%Y'), '%Y-%m-%d') AS event_date, {title("client")} AS client,
         branch, menu, {coerce_int("guests")} AS guests, slot,
         {currency("price_per_guest")} AS price_per_guest, {currency("total")} AS total,
         substr(strftime(try_strptime(event_date, '%d/%m/%Y'), '%Y-%m-%d'), 1, 7) AS month
  FROM fx_bookings WHERE status = 'Ganado'),
booking_monthly AS (
  SELECT branch, month, count(event_date) AS events, CAST(sum(guests) AS BIGINT) AS guests,
         CAST(coalesce(sum(CAST(total AS DECIMAL(20,2))), 0) AS DOUBLE) AS income
  FROM bookings_clean WHERE branch IS NOT NULL AND month IS NOT NULL GROUP BY branch, month)
"""


def sql(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {FIXTURES}{extra}\n{body}"


# ------------------------------------------------------------------ KPIs

def _kpi_cte(as_of: dt.date, name: str = "kpi") -> str:
    a, m, pm, d30 = _d(as_of), _m(as_of), _m(_prev_month(as_of)), _d(as_of - dt.timedelta(days=30))
    cols = f"""coalesce(sum(amount) FILTER (WHERE month = {m}), 0) AS mtd,
      coalesce(sum(amount) FILTER (WHERE month = {pm}), 0) AS prev,
      coalesce(sum(amount) FILTER (WHERE day = {a}), 0) AS today,
      coalesce(sum(amount) FILTER (WHERE day >= {d30}), 0) AS last30,
      coalesce(sum(amount), 0) AS total, count(DISTINCT month) AS months"""
    return f"""{name}_p AS (SELECT * FROM payments_live WHERE day IS NULL OR day <= {a}),
{name} AS (
  SELECT branch, {cols} FROM {name}_p WHERE branch IS NOT NULL GROUP BY branch
  UNION ALL SELECT 'ALL' AS branch, {cols} FROM {name}_p)"""


def _kpi_select(name: str = "kpi") -> str:
    return f"""SELECT branch, CAST(mtd AS DOUBLE) AS month_to_date,
  CAST(total AS DOUBLE) / NULLIF(CAST(months AS DOUBLE), 0) AS avg_per_month,
  CAST(today AS DOUBLE) AS today, CAST(last30 AS DOUBLE) / 30.0 AS avg_per_day_30,
  CAST(prev AS DOUBLE) AS previous_month FROM {name}"""


def branch_kpis() -> str:
    return sql(_kpi_select(), _kpi_cte(Q.AS_OF))


def branch_kpis_edges() -> str:
    ctes = ",\n".join(_kpi_cte(d, f"k{i}") for i, d in enumerate(fx.AS_OF_EDGES))
    body = "\nUNION ALL\n".join(f"SELECT *, {_d(d)} AS as_of FROM ({_kpi_select(f'k{i}')})"
                                for i, d in enumerate(fx.AS_OF_EDGES))
    return sql(body, ctes)


def mom_growth() -> str:
    return sql("SELECT branch, CAST(mtd - prev AS DOUBLE) / NULLIF(CAST(prev AS DOUBLE), 0) * 100.0 AS growth_pct "
               "FROM kpi", _kpi_cte(Q.AS_OF))


# ------------------------------------------------------------------ reports

def _top_products(a: dt.date, n: str = "") -> tuple[str, str]:
    ms, y = a.replace(day=1), a - dt.timedelta(days=1)
    ctes = f"""t{n} AS (SELECT branch, product_name AS product, quantity, price, day FROM lines_enriched
          WHERE day >= {_d(min(ms, y))} AND day <= {_d(a)} AND product_name IS NOT NULL),
tagged{n} AS (
  SELECT 'month' AS report, * FROM t{n} WHERE day >= {_d(ms)}
  UNION ALL SELECT 'today' AS report, * FROM t{n} WHERE day = {_d(a)}
  UNION ALL SELECT 'yesterday' AS report, * FROM t{n} WHERE day = {_d(y)}),
agg{n} AS (
  SELECT report, branch AS scope, product, sum(quantity) AS q, sum(price) AS r FROM tagged{n}
  WHERE branch IS NOT NULL GROUP BY report, branch, product
  UNION ALL
  SELECT report, 'ALL' AS scope, product, sum(quantity) AS q, sum(price) AS r FROM tagged{n} GROUP BY report, product)"""
    body = f"""SELECT report, scope, product, CAST(q AS DOUBLE) AS qty, CAST(r AS DOUBLE) AS revenue
FROM agg{n}"""
    return ctes, body


def top_products() -> str:
    ctes, body = _top_products(Q.AS_OF)
    return sql(body, ctes)


def top_products_ranked() -> str:
    return (f"SELECT *, row_number() OVER (PARTITION BY report, scope ORDER BY qty DESC, product) AS rank "
            f"FROM ({top_products()}) AS r")


def top_products_edges() -> str:
    parts = [_top_products(d, str(i)) for i, d in enumerate(fx.AS_OF_EDGES)]
    ctes = ",\n".join(c for c, _ in parts)
    body = "\nUNION ALL\n".join(f"SELECT *, {_d(d)} AS as_of FROM ({b})" for d, (_, b) in zip(fx.AS_OF_EDGES, parts))
    return sql(body, ctes)


def top_products_day() -> str:
    body = f"""SELECT product_name AS product, CAST(sum(quantity) AS DOUBLE) AS qty FROM lines_enriched
WHERE branch = '{Q.RANK_BRANCH}' AND day = {_d(Q.RANK_DAY)} AND product_name IS NOT NULL
GROUP BY product_name ORDER BY qty DESC, product ASC"""
    return sql(body)


def daily_reconciliation() -> str:
    ctes = """li AS (SELECT branch, day, sum(price) AS v FROM lines_enriched
       WHERE branch IS NOT NULL AND day IS NOT NULL GROUP BY branch, day),
pa AS (SELECT branch, day, sum(amount) AS v FROM payments_live
       WHERE branch IS NOT NULL AND day IS NOT NULL GROUP BY branch, day),
sa AS (SELECT branch, CAST(created_at AS DATE) AS day, sum(total) AS v FROM fx_sales
       WHERE branch IS NOT NULL AND created_at IS NOT NULL GROUP BY branch, CAST(created_at AS DATE)),
lp AS (SELECT coalesce(li.branch, pa.branch) AS branch, coalesce(li.day, pa.day) AS day,
              li.v AS lv, pa.v AS pv
       FROM li FULL OUTER JOIN pa ON li.branch = pa.branch AND li.day = pa.day)"""
    body = """SELECT coalesce(lp.branch, sa.branch) AS branch, coalesce(lp.day, sa.day) AS day,
  CAST(coalesce(lp.lv, 0) AS DOUBLE) AS line_revenue, CAST(coalesce(lp.pv, 0) AS DOUBLE) AS payment_amount,
  CAST(coalesce(sa.v, 0) AS DOUBLE) AS sale_total
FROM lp FULL OUTER JOIN sa ON lp.branch = sa.branch AND lp.day = sa.day"""
    return sql(body, ctes)


def weekly_reconciliation() -> str:
    s, e = Q.WEEK
    ctes = f"""li AS (SELECT branch, day, sum(price) AS v FROM lines_enriched
       WHERE branch IS NOT NULL AND day BETWEEN {_d(s)} AND {_d(e)} GROUP BY branch, day),
sa AS (SELECT branch, CAST(created_at AS DATE) AS day, sum(total) AS v FROM fx_sales
       WHERE branch IS NOT NULL AND CAST(created_at AS DATE) BETWEEN {_d(s)} AND {_d(e)}
       GROUP BY branch, CAST(created_at AS DATE)),
d AS (SELECT coalesce(li.branch, sa.branch) AS branch, coalesce(li.day, sa.day) AS day,
             coalesce(li.v, 0) AS lv, coalesce(sa.v, 0) AS sv
      FROM li FULL OUTER JOIN sa ON li.branch = sa.branch AND li.day = sa.day)"""
    body = """SELECT branch, day, CAST(lv AS DOUBLE) AS line_revenue, CAST(sv AS DOUBLE) AS sale_total,
  CAST(sum(lv) OVER (PARTITION BY branch) AS DOUBLE) AS week_line_revenue,
  CAST(sum(sv) OVER (PARTITION BY branch) AS DOUBLE) AS week_sale_total
FROM d"""
    return sql(body, ctes)


# ------------------------------------------------------------------ scalar suite

def scalar_suite() -> str:
    k = "o_orderkey"
    date_text = f"CASE WHEN {k} % 97 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%-d/%-m/%Y') END"
    iso = f"strftime(try_strptime({date_text}, '%d/%m/%Y'), '%Y-%m-%d')"
    id_text = f"CASE WHEN {k} % 11 = 0 THEN CAST({k} AS VARCHAR) || 'a' ELSE CAST({k} AS VARCHAR) END"
    total_text = (f"CASE WHEN {k} % 89 = 0 THEN '-' ELSE 'AR$ ' || replace(replace(replace("
                  f"format('{{:,.2f}}', o_totalprice), ',', '|'), '.', ','), '|', '.') END")
    guests_text = f"CASE WHEN {k} % 7 = 0 THEN 'x' ELSE CAST(({k} % 60) / 7 AS VARCHAR) END"
    name = "concat_ws(' ', c_name, o_orderpriority)"
    body = f"""SELECT {k} AS o_orderkey, TRY_CAST({id_text} AS BIGINT) AS id_num, {iso} AS date_iso,
  substr({iso}, 1, 7) AS month, {currency(total_text)} AS total_num,
  {title("concat_ws(' ', lower(c_name), o_orderpriority)")} AS client_title,
  {coerce_int(guests_text)} AS guests_int,
  round_even(o_totalprice / 1000, 0) AS rounded0,
  round_even((o_totalprice / 7) * 100.0, 0) / 100.0 AS rounded2,
  CAST(o_totalprice - c_acctbal AS DOUBLE) / NULLIF(CAST(c_acctbal AS DOUBLE), 0) * 100.0 AS growth,
  {trunc_name(name)} AS name_short, CAST(o_orderdate AS DATE) AS day
FROM ob"""
    return sql(body)


def timestamps_normalised() -> str:
    return sql("SELECT event_id, ts AS local_ts, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS month FROM events")


# ------------------------------------------------------------------ dedupe / upsert

def _split(table: str, date_col: str, split: dt.date, bump: str, cols: list[str]) -> str:
    start = split - dt.timedelta(days=fx.OVERLAP_DAYS)
    new_cols = ", ".join(f"CAST({c} + 1 AS DECIMAL(18,2)) AS {c}" if c == bump else c for c in cols)
    return f"""u AS (
  SELECT {", ".join(cols)}, 0 AS ingest_seq FROM {table} WHERE CAST({date_col} AS DATE) < {_d(split)}
  UNION ALL
  SELECT {new_cols}, 1 AS ingest_seq FROM {table} WHERE CAST({date_col} AS DATE) >= {_d(start)})"""


def _keep_last(keys: list[str], order: str, cols: list[str]) -> str:
    out = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in ("total", "price", "quantity", "amount") else c for c in cols)
    return (f"SELECT {out} FROM u QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order}) = 1")


SALE_SRC = Q.SALE_COLS
LINE_SRC = Q.LINE_COLS + ["line_number", "ship_date"]
PAY_SRC = Q.PAYMENT_COLS


def dedupe_sales() -> str:
    return sql(_keep_last(Q.SALE_KEYS, "ingest_seq DESC", Q.SALE_COLS),
               _split("fx_sales", "created_at", fx.SPLIT_DATE, "total", SALE_SRC))


upsert_sales = dedupe_sales


def dedupe_payments() -> str:
    return sql(_keep_last(Q.PAYMENT_KEYS, "ingest_seq DESC", Q.PAYMENT_COLS),
               _split("fx_payments_ev", "created_at", fx.EVENTS_SPLIT_DATE, "amount", PAY_SRC))


upsert_payments = dedupe_payments
stream_upsert_payments = stream_keyed_state = dedupe_payments


def upsert_lines() -> str:
    return sql(_keep_last(Q.LINE_KEYS, "ingest_seq DESC, line_number DESC, ship_date DESC, price DESC", Q.LINE_COLS),
               _split("fx_lines", "ship_date", fx.SPLIT_DATE, "price", LINE_SRC))


def dedupe_lines() -> str:
    return sql(_keep_last(Q.LINE_KEYS, "line_number DESC, ship_date DESC, price DESC", Q.LINE_COLS),
               "u AS (SELECT * FROM fx_lines)")


def dedupe_catalog() -> str:
    ctes = """u AS (
  SELECT product_id, product_name, product_category, branch, 0 AS ingest_seq FROM fx_catalog
  UNION ALL
  SELECT product_id, upper(product_name), product_category, branch, 1 FROM fx_catalog
  WHERE TRY_CAST(product_id AS BIGINT) % 2 = 0)"""
    return sql("SELECT product_id, product_name, product_category, branch FROM u "
               "QUALIFY row_number() OVER (PARTITION BY product_id, branch ORDER BY ingest_seq DESC) = 1", ctes)


def catalog_refresh() -> str:
    ctes = """fetched AS (
  SELECT p.product_id, p.product_name, c.product_category, p.branch
  FROM (SELECT product_id, product_name, branch FROM fx_catalog WHERE TRY_CAST(product_id AS BIGINT) % 2 = 0) p
  LEFT JOIN (SELECT product_id, product_category, branch FROM fx_catalog
             WHERE product_category IS NOT NULL AND TRY_CAST(product_id AS BIGINT) % 2 = 0) c
    ON p.product_id = c.product_id AND p.branch = c.branch),
u AS (
  SELECT product_id, lower(product_name) AS product_name, product_category, branch, 0 AS ingest_seq FROM fx_catalog
  UNION ALL SELECT *, 1 FROM fetched)"""
    return sql("SELECT product_id, product_name, product_category, branch FROM u "
               "QUALIFY row_number() OVER (PARTITION BY product_id, branch ORDER BY ingest_seq DESC) = 1", ctes)


def catalog_inner() -> str:
    return sql("""SELECT p.product_id, p.product_name, c.product_category, p.branch
FROM fx_catalog p JOIN (SELECT product_id, product_category, branch FROM fx_catalog WHERE product_category IS NOT NULL) c
  ON p.product_id = c.product_id AND p.branch = c.branch""")


def catalog_left() -> str:
    return sql("""SELECT p.product_id, p.product_name, c.product_category, p.branch
FROM fx_catalog p LEFT JOIN (SELECT product_id, product_category, branch FROM fx_catalog WHERE product_category IS NOT NULL) c
  ON p.product_id = c.product_id AND p.branch = c.branch""")


# ------------------------------------------------------------------ incremental

def _trimmed(src: str, name: str) -> str:
    return f"""{name}_c AS (SELECT * FROM {src} WHERE closed_at IS NOT NULL),
{name}_tail AS (SELECT sale_id, branch FROM {name}_c
  ORDER BY TRY_CAST(sale_id AS BIGINT) DESC NULLS LAST, sale_id DESC LIMIT 20),
{name} AS (SELECT * FROM {name}_c
  WHERE (SELECT count(*) FROM {name}_c) <= 20
     OR NOT EXISTS (SELECT 1 FROM {name}_tail t WHERE t.sale_id = {name}_c.sale_id
                    AND t.branch IS NOT DISTINCT FROM {name}_c.branch))"""


def closed_sales_trimmed() -> str:
    out = ", ".join("CAST(total AS DOUBLE) AS total" if c == "total" else c for c in Q.SALE_COLS)
    return sql(f"SELECT {out} FROM trimmed", _trimmed("fx_sales", "trimmed"))


def highwater_marks() -> str:
    body = """SELECT 'sales' AS source, branch, coalesce(max(TRY_CAST(sale_id AS BIGINT)), 0) AS last_id
FROM trimmed WHERE branch IS NOT NULL GROUP BY branch
UNION ALL
SELECT 'payments' AS source, branch, coalesce(max(TRY_CAST(payment_id AS BIGINT)), 0) AS last_id
FROM fx_payments_ev WHERE branch IS NOT NULL GROUP BY branch"""
    return sql(body, _trimmed("fx_sales", "trimmed"))


def incremental_selection() -> str:
    ctes = f"""s_old AS (SELECT * FROM fx_sales WHERE CAST(created_at AS DATE) < {_d(fx.SPLIT_DATE)}),
{_trimmed("s_old", "s_trim")},
s_marks AS (SELECT branch, coalesce(max(TRY_CAST(sale_id AS BIGINT)), 0) AS last_id FROM s_trim
            WHERE branch IS NOT NULL GROUP BY branch),
p_marks AS (SELECT branch, coalesce(max(TRY_CAST(payment_id AS BIGINT)), 0) AS last_id FROM fx_payments_ev
            WHERE CAST(created_at AS DATE) < {_d(fx.EVENTS_SPLIT_DATE)} AND branch IS NOT NULL GROUP BY branch)"""
    body = """SELECT 'sales' AS source, s.sale_id AS id, s.branch, coalesce(m.last_id, 0) AS mark
FROM fx_sales s LEFT JOIN s_marks m ON s.branch = m.branch
WHERE TRY_CAST(s.sale_id AS BIGINT) > coalesce(m.last_id, 0)
UNION ALL
SELECT 'payments' AS source, p.payment_id AS id, p.branch, coalesce(m.last_id, 0) AS mark
FROM fx_payments_ev p LEFT JOIN p_marks m ON p.branch = m.branch
WHERE TRY_CAST(p.payment_id AS BIGINT) > coalesce(m.last_id, 0)"""
    return sql(body, ctes)


# ------------------------------------------------------------------ documents

def _money_out(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in ("total", "price", "quantity", "amount") else c
                     for c in cols)


def json_sales_flat() -> str:
    return sql(f"SELECT {_money_out(Q.SALE_COLS)} FROM fx_sales")


def json_sale_single() -> str:
    return json_items_flat()


def json_payment_single() -> str:
    return json_payments_flat()


def json_items_flat() -> str:
    return sql(f"SELECT {_money_out(Q.LINE_COLS)} FROM fx_lines")


def json_payments_flat() -> str:
    return sql(f"SELECT {_money_out(Q.PAYMENT_COLS)} FROM fx_payments_ev")


def json_categories_flat() -> str:
    return sql("SELECT product_category, product_id, branch FROM fx_catalog WHERE product_category IS NOT NULL")


def json_products_flat() -> str:
    return sql("SELECT product_id, product_name, branch FROM fx_catalog")


def bootstrap_raw() -> str:
    return sql("""SELECT 'sales' AS raw_table, sale_id AS id, CAST(NULL AS VARCHAR) AS detail, branch,
  CAST(total AS DOUBLE) AS amount, strftime(created_at, '%Y-%m') AS part FROM fx_sales
UNION ALL SELECT 'lines', l.sale_id, l.product_id, l.branch, CAST(l.price AS DOUBLE), strftime(s.created_at, '%Y-%m')
  FROM fx_lines l LEFT JOIN fx_sales s ON l.sale_id = s.sale_id AND l.branch IS NOT DISTINCT FROM s.branch
UNION ALL SELECT 'payments', payment_id, method, branch, CAST(amount AS DOUBLE), strftime(created_at, '%Y-%m')
  FROM fx_payments_ev
UNION ALL SELECT 'products', product_id, product_category, branch, CAST(NULL AS DOUBLE), branch
  FROM fx_catalog WHERE product_category IS NOT NULL""")


def upsert_raw_rows() -> str:
    return sql("""SELECT 'sales' AS raw_table, sale_id AS id, CAST(NULL AS VARCHAR) AS detail, branch,
  CAST(total + CASE WHEN sid * 4 > max(sid) OVER () * 3 THEN 1 ELSE 0 END AS DOUBLE) AS amount,
  strftime(created_at, '%Y-%m') AS part FROM (SELECT *, TRY_CAST(sale_id AS BIGINT) AS sid FROM fx_sales)
UNION ALL SELECT 'lines', l.sale_id, l.product_id, l.branch, CAST(sum(l.price) AS DOUBLE), any_value(strftime(s.created_at, '%Y-%m'))
  FROM fx_lines l LEFT JOIN fx_sales s ON l.sale_id = s.sale_id AND l.branch IS NOT DISTINCT FROM s.branch
  GROUP BY l.sale_id, l.product_id, l.branch
UNION ALL SELECT 'payments', payment_id, method, branch,
  CAST(amount + CASE WHEN pid * 4 > max(pid) OVER () * 3 THEN 1 ELSE 0 END AS DOUBLE), strftime(created_at, '%Y-%m')
  FROM (SELECT *, TRY_CAST(payment_id AS BIGINT) AS pid FROM fx_payments_ev)
UNION ALL SELECT 'products', product_id, product_category, branch, CAST(NULL AS DOUBLE), branch FROM fx_catalog""")


incremental_upsert = upsert_raw_rows


def upsert_moved_keys() -> str:
    from branchlens.plans.raw_queries import MOVE_DAYS, RETURN_DAYS
    ctes = _split("fx_sales", "created_at", fx.SPLIT_DATE, "total", ["sale_id", "total", "created_at", "branch"]) + f""",
moved AS (SELECT * REPLACE (CASE WHEN ingest_seq = 1 AND TRY_CAST(sale_id AS BIGINT) % 3 = 0
          THEN created_at + INTERVAL {MOVE_DAYS} DAY ELSE created_at END AS created_at) FROM u),
again AS (SELECT * FROM moved UNION ALL SELECT * REPLACE (created_at - INTERVAL {RETURN_DAYS} DAY AS created_at, 2 AS ingest_seq)
          FROM moved WHERE ingest_seq = 1 AND TRY_CAST(sale_id AS BIGINT) % 5 = 0)"""
    return sql("""SELECT sale_id, CAST(total AS DOUBLE) AS total, created_at, strftime(created_at, '%Y-%m') AS month, branch
FROM again QUALIFY row_number() OVER (PARTITION BY sale_id, branch ORDER BY ingest_seq DESC) = 1""", ctes)


# ------------------------------------------------------------------ marts

def lines_enriched() -> str:
    return sql("""SELECT sale_id, product_id, branch, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
  sale_type, day, month, product_name, product_category FROM lines_enriched""")


def dwell_filtered() -> str:
    lo, hi = fx.DWELL_DAYS
    return sql(f"""SELECT sale_id, branch, CAST(total AS DOUBLE) AS total, CAST(created_at AS DATE) AS created_day,
  CAST(closed_at AS DATE) AS closed_day, date_diff('second', created_at, closed_at) AS dwell_seconds
FROM fx_sales WHERE sale_type = '{fx.DINE_IN_TYPE}'
  AND date_diff('second', created_at, closed_at) >= {lo * 86400}
  AND date_diff('second', created_at, closed_at) < {hi * 86400}""")


def payments_live() -> str:
    return sql(f"""SELECT payment_id, branch, CAST(amount AS DOUBLE) AS amount, method, created_at,
  CAST(created_at AS DATE) AS day, strftime(created_at, '%Y-%m') AS month
FROM fx_payments_ev WHERE {LIVE}""")


def daily_revenue_all() -> str:
    return sql("""SELECT day, CAST(round_even(CAST(s AS DOUBLE), 0) AS BIGINT) AS revenue FROM (
  SELECT day, sum(amount) AS s FROM payments_live WHERE day IS NOT NULL GROUP BY day) WHERE s > 0""")


def daily_revenue_branch() -> str:
    return sql("""SELECT branch, day, round_even(CAST(s AS DOUBLE), 0) AS revenue FROM (
  SELECT branch, day, sum(amount) AS s FROM payments_live WHERE branch IS NOT NULL AND day IS NOT NULL
  GROUP BY branch, day) WHERE s > 0""")


def product_daily() -> str:
    return sql("SELECT branch, day, product, CAST(qty AS DOUBLE) AS qty, CAST(revenue AS DOUBLE) AS revenue "
               "FROM product_daily")


def category_daily() -> str:
    return sql("SELECT branch, day, category, CAST(qty AS DOUBLE) AS qty, CAST(revenue AS DOUBLE) AS revenue "
               "FROM category_daily")


def _totals_cte(src: str, key: str) -> str:
    return f"""tot AS (SELECT branch, {key}, CAST(sum(qty) AS DOUBLE) AS qty, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(qty) AS DOUBLE) / count(*) AS avg_daily_qty, CAST(sum(revenue) AS DOUBLE) / count(*) AS avg_daily_revenue
  FROM {src} GROUP BY branch, {key})"""


def product_totals() -> str:
    cols = ", ".join(f"coalesce({r2(c)}, 0) AS {c}" for c in ("qty", "revenue", "avg_daily_qty", "avg_daily_revenue"))
    return sql(f"SELECT branch, product, {cols} FROM tot", _totals_cte("product_daily", "product"))


def category_totals() -> str:
    return sql("SELECT * FROM tot", _totals_cte("category_daily", "category"))


def monthly_revenue() -> str:
    ctes = """mb AS (SELECT branch, month, CAST(round_even(CAST(sum(amount) AS DOUBLE), 0) AS BIGINT) AS revenue
  FROM payments_live WHERE branch IS NOT NULL AND month IS NOT NULL GROUP BY branch, month)"""
    return sql("SELECT branch, month, revenue FROM mb UNION ALL "
               "SELECT 'ALL' AS branch, month, CAST(sum(revenue) AS BIGINT) AS revenue FROM mb GROUP BY month", ctes)


def monthly_line_revenue() -> str:
    return sql("SELECT month, CAST(coalesce(sum(price), 0) AS DOUBLE) AS line_revenue FROM lines_enriched "
               "WHERE month IS NOT NULL GROUP BY month")


def marts_incremental() -> str:
    ctes = f"""pl AS (SELECT *, CAST(created_at AS DATE) AS day, strftime(created_at, '%Y-%m') AS month
  FROM fx_payments_ev WHERE {LIVE}),
mb AS (SELECT branch, month, CAST(round_even(CAST(sum(amount) AS DOUBLE), 0) AS BIGINT) AS revenue
  FROM pl WHERE branch IS NOT NULL AND month IS NOT NULL GROUP BY branch, month),
{_totals_cte("product_daily", "product").replace("tot AS", "ptot AS")},
{_totals_cte("category_daily", "category").replace("tot AS", "ctot AS")}"""
    cols = ", ".join(f"coalesce({r2(c)}, 0)" for c in ("qty", "revenue", "avg_daily_qty", "avg_daily_revenue"))
    return sql(f"""SELECT 'daily_revenue_all' AS mart, CAST(NULL AS VARCHAR) AS branch, strftime(day, '%Y-%m-%d') AS key,
  CAST(NULL AS VARCHAR) AS detail, round_even(CAST(sum(amount) AS DOUBLE), 0) AS m1, CAST(NULL AS DOUBLE) AS m2,
  CAST(NULL AS DOUBLE) AS m3, CAST(NULL AS DOUBLE) AS m4 FROM pl WHERE day IS NOT NULL GROUP BY day HAVING sum(amount) > 0
UNION ALL SELECT 'daily_revenue_branch', branch, strftime(day, '%Y-%m-%d'), NULL, round_even(CAST(sum(amount) AS DOUBLE), 0),
  NULL, NULL, NULL FROM pl WHERE branch IS NOT NULL AND day IS NOT NULL GROUP BY branch, day HAVING sum(amount) > 0
UNION ALL SELECT 'monthly_revenue', branch, month, NULL, CAST(revenue AS DOUBLE), NULL, NULL, NULL FROM mb
UNION ALL SELECT 'monthly_revenue', 'ALL', month, NULL, CAST(sum(revenue) AS DOUBLE), NULL, NULL, NULL FROM mb GROUP BY month
UNION ALL SELECT 'monthly_line_revenue', NULL, month, NULL, CAST(coalesce(sum(price), 0) AS DOUBLE), NULL, NULL, NULL
  FROM lines_enriched WHERE month IS NOT NULL GROUP BY month
UNION ALL SELECT 'product_daily', branch, strftime(day, '%Y-%m-%d'), product, CAST(qty AS DOUBLE), CAST(revenue AS DOUBLE), NULL, NULL
  FROM product_daily
UNION ALL SELECT 'category_daily', branch, strftime(day, '%Y-%m-%d'), category, CAST(qty AS DOUBLE), CAST(revenue AS DOUBLE), NULL, NULL
  FROM category_daily
UNION ALL SELECT 'product_totals', branch, product, NULL, {cols} FROM ptot
UNION ALL SELECT 'category_totals', branch, category, NULL, qty, revenue, avg_daily_qty, avg_daily_revenue FROM ctot""", ctes)


def product_category_pairs() -> str:
    return sql("SELECT product, category FROM pairs")


def new_product_categories() -> str:
    return sql("""SELECT product, category FROM pairs p WHERE NOT EXISTS (
  SELECT 1 FROM fx_known_pairs k WHERE k.product = p.product AND k.category = p.category)""")


# ------------------------------------------------------------------ written and read back

def mart_published() -> str:
    return daily_revenue_branch()


def pairs_appended() -> str:
    return sql("""SELECT product, category FROM fx_known_pairs UNION ALL
SELECT product, category FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM fx_known_pairs k WHERE k.product = p.product)""")


def reports_published() -> str:
    return top_products()


def lines_enriched_bucketed() -> str:
    return lines_enriched()


def facts_published() -> str:
    return lines_enriched()


def raw_csv_read() -> str:
    return sql("""SELECT sale_id, CAST(total AS DOUBLE) AS total, sale_type, created_at, closed_at, customer_id, branch
FROM fx_sales""")


def sheet_read() -> str:
    from branchlens.plans.sink_queries import CELL_END
    end = CELL_END.replace("\n", "' || chr(10) || '")
    return sql(f"SELECT * REPLACE (client || '{end}' AS client) FROM fx_bookings")


# ------------------------------------------------------------------ bookings

def bookings_clean() -> str:
    return sql("SELECT * FROM bookings_clean")


def booking_monthly() -> str:
    return sql("SELECT * FROM booking_monthly")


def _booking_metrics_select(as_of: dt.date) -> str:
    months = {"prev": as_of - dt.timedelta(days=30), "cur": as_of, "next": as_of + dt.timedelta(days=30)}
    joins, cols = [], []
    for tag, d in months.items():
        joins.append(f"LEFT JOIN (SELECT branch, events, guests, income FROM booking_monthly WHERE month = {_m(d)}) {tag} "
                     f"ON m.branch = {tag}.branch")
        cols += [f"coalesce({tag}.events, 0) AS events_{tag}", f"coalesce({tag}.guests, 0) AS guests_{tag}",
                 f"coalesce({tag}.income, 0.0) AS income_{tag}"]
    return (f"SELECT m.branch, m.month, m.events, m.guests, m.income, {', '.join(cols)} "
            f"FROM booking_monthly m {' '.join(joins)}")


def booking_metrics() -> str:
    return sql(_booking_metrics_select(Q.AS_OF))


def booking_metrics_edges() -> str:
    return sql("\nUNION ALL\n".join(f"SELECT *, {_d(d)} AS as_of FROM ({_booking_metrics_select(d)})"
                                    for d in fx.AS_OF_EDGES))


# ------------------------------------------------------------------ quality

def _dup(src: str, name: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""SELECT '{name}' AS mart, '{",".join(keys)}' AS key, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
  count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT {k}, count(*) AS n FROM {src} GROUP BY {k})"""


def quality_unique() -> str:
    ctes = """drb AS (SELECT branch, day FROM payments_live WHERE branch IS NOT NULL AND day IS NOT NULL
        GROUP BY branch, day HAVING sum(amount) > 0),
mr AS (SELECT DISTINCT branch, month FROM payments_live WHERE branch IS NOT NULL AND month IS NOT NULL),
kb AS (SELECT DISTINCT branch FROM payments_live WHERE branch IS NOT NULL)"""
    body = "\nUNION ALL\n".join([
        _dup("product_daily", "product_daily", ["day", "product"]),
        _dup("category_daily", "category_daily", ["day", "category"]),
        _dup("pairs", "product_category", ["product"]),
        _dup("drb", "daily_revenue_branch", ["day"]),
        _dup("mr", "monthly_revenue", ["month"]),
        _dup("kb", "branch_kpis", ["branch"]),
        _dup("booking_monthly", "booking_monthly", ["branch", "month"]),
    ])
    return sql(body, ctes)


def quality_fk() -> str:
    body = """SELECT 'product_daily.product->product_category' AS "check", count(*) AS orphan_keys FROM (
  SELECT DISTINCT product FROM product_daily WHERE product IS NOT NULL
  EXCEPT SELECT DISTINCT product FROM pairs)
UNION ALL
SELECT 'category_daily.category->categories', count(*) FROM (
  SELECT DISTINCT category FROM category_daily
  EXCEPT SELECT DISTINCT product_category FROM fx_catalog)
UNION ALL
SELECT 'daily_revenue_branch.branch->branches', count(*) FROM (
  SELECT DISTINCT branch FROM payments_live WHERE branch IS NOT NULL AND day IS NOT NULL
  EXCEPT SELECT r_name FROM region)
UNION ALL
SELECT 'lines.sale_id->sales', count(*) FROM (
  SELECT DISTINCT sale_id FROM fx_lines WHERE sale_id IS NOT NULL EXCEPT SELECT sale_id FROM fx_sales)
UNION ALL
SELECT 'booking_monthly.branch->branches', count(*) FROM (
  SELECT DISTINCT branch FROM booking_monthly EXCEPT SELECT r_name FROM region)"""
    return sql(body)


def quality_nulls() -> str:
    parts = []
    for table, cols in (("lines_enriched", ["branch", "day", "product_name", "product_category"]),
                        ("fx_sales", ["branch", "closed_at", "customer_id"])):
        name = "sales" if table == "fx_sales" else table
        for c in cols:
            parts.append(f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS null_rows, count(*) AS rows FROM {table}")
    return sql("\nUNION ALL\n".join(parts))


def accepted_rejected() -> str:
    return sql("""SELECT product, category,
  CASE WHEN product IS NULL THEN 'rejected' WHEN rn = 1 THEN 'accepted' ELSE 'rejected' END AS status,
  CASE WHEN product IS NULL THEN 'null_key' WHEN rn = 1 THEN NULL ELSE 'duplicate_key' END AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY product ORDER BY category ASC NULLS LAST) AS rn FROM pairs)""")


def run_summary() -> str:
    lo, hi = fx.DWELL_DAYS
    return sql(f"""SELECT 'sales' AS fact, count(*) AS rows FROM fx_sales
UNION ALL SELECT 'items', count(*) FROM lines_enriched
UNION ALL SELECT 'dwell', count(*) FROM fx_sales WHERE sale_type = '{fx.DINE_IN_TYPE}'
  AND date_diff('second', created_at, closed_at) >= {lo * 86400} AND date_diff('second', created_at, closed_at) < {hi * 86400}
UNION ALL SELECT 'payments', count(*) FROM payments_live""")


# Columns rendered as text in the publish format (see ``catalog.publishable``).
_SALE_TS = {"ts": ["created_at", "closed_at"]}
_PAY = {"ts": ["created_at"], "bool": ["canceled"]}
_LINE = {"bool": ["canceled"]}
PUBLISH: dict[str, dict[str, list[str]]] = {
    "lines_enriched": {"date": ["day"]},
    "dwell_filtered": {"date": ["created_day", "closed_day"]},
    "payments_live": {"date": ["day"], "ts": ["created_at"]},
    "daily_revenue_all": {"date": ["day"]},
    "daily_revenue_branch": {"date": ["day"]},
    "product_daily": {"date": ["day"]},
    "category_daily": {"date": ["day"]},
    "branch_kpis_edges": {"date": ["as_of"]},
    "daily_reconciliation": {"date": ["day"]},
    "weekly_reconciliation": {"date": ["day"]},
    "timestamps_normalised": {"date": ["day"], "ts": ["local_ts"]},
    "scalar_suite": {"date": ["day"], "text": ["id_num"]},
    "booking_metrics_edges": {"date": ["as_of"]},
    "top_products_edges": {"date": ["as_of"]},
    "dedupe_sales": _SALE_TS, "upsert_sales": _SALE_TS, "json_sales_flat": _SALE_TS,
    "closed_sales_trimmed": _SALE_TS,
    "dedupe_lines": _LINE, "upsert_lines": _LINE, "json_items_flat": _LINE, "json_sale_single": _LINE,
    "dedupe_payments": _PAY, "upsert_payments": _PAY, "json_payments_flat": _PAY, "json_payment_single": _PAY,
    "stream_upsert_payments": _PAY, "stream_keyed_state": _PAY, "upsert_moved_keys": {"ts": ["created_at"]},
    "raw_csv_read": _SALE_TS, "mart_published": {"date": ["day"]}, "facts_published": {"date": ["day"]},
    "lines_enriched_bucketed": {"date": ["day"]},
}


def publish(name: str, query: str) -> str:
    spec = PUBLISH.get(name)
    if not spec:
        return query
    repl = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in spec.get("date", [])]
    repl += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in spec.get("ts", [])]
    repl += [f"CAST({c} AS VARCHAR) AS {c}" for c in spec.get("bool", []) + spec.get("text", [])]
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{query}\n) AS published"


ORACLE: dict[str, str] = {}
for _name in Q.QUERIES:
    _fn = globals().get(_name)
    if callable(_fn):
        ORACLE[_name] = publish(_name, _fn())
