"""Independent SQL (DuckDB dialect) for the registered queries.

Each string computes, from the raw driver tables, what the matching Spark
query computes through the library operators.  The SQL shares no code with
the Spark side except a few text helpers that expand the published
rounding rules (see ``riskweave.functions``) into SQL expressions.
"""

from __future__ import annotations

from riskweave.plans import adapters as A
from riskweave.plans import flows
from riskweave.plans import queries as QY
from riskweave.sources.schemas import DRIVER

C = f"TIMESTAMP '{A.CUTOFF}'"


def half_up(num: str, den: str, digits: int) -> str:
    """Exact HALF_UP rounding of the integer fraction num/den; NULL if den = 0."""
    s = 10 ** digits
    return (f"(CAST((({num}) * {2 * s} + ({den})) // nullif(2 * ({den}), 0) AS DOUBLE)"
            f" / {s}.0)")


def rnd(x: str, digits: int) -> str:
    s = 10 ** digits
    return f"(floor(({x}) * {s}.0 + 0.5) / {s}.0)"


def units(x: str, digits: int) -> str:
    return f"CAST(floor(({x}) * {10 ** digits}.0 + 0.5) AS BIGINT)"


def avg_units(x: str, digits: int) -> str:
    return half_up(f"sum({units(x, digits)})", f"count({x}) * {10 ** digits}", digits)


def pct1(x: str) -> str:
    u = f"CAST(floor(({x}) * 1000.0 + 0.5) AS BIGINT)"
    return f"(CAST({u} // 10 AS VARCHAR) || '.' || CAST({u} % 10 AS VARCHAR) || '%')"


def short_pct(x: str) -> str:
    u = f"CAST(floor(({x}) * 10000.0 + 0.5) AS BIGINT)"
    f = f"({u} % 100)"
    tail = (f"CASE WHEN {f} = 0 THEN '0' WHEN {f} % 10 = 0 THEN CAST({f} // 10 AS VARCHAR) "
            f"ELSE lpad(CAST({f} AS VARCHAR), 2, '0') END")
    return f"(CAST({u} // 100 AS VARCHAR) || '.' || {tail} || '%')"


def thousands(x: str) -> str:
    return f"replace(format('{{:,}}', CAST({x} AS BIGINT)), ',', '.')"


def flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END AS DOUBLE)"


def bucket(key: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 6))::BIGINT % 100 AS INTEGER)"


# ----------------------------------------------------------------- CTEs
LINES = """lines AS (
  SELECT l_orderkey, count(*) AS n_lines,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned,
         sum(l_quantity) AS qty_sum,
         CAST(sum(CASE WHEN l_quantity < 30 THEN 1 ELSE 0 END) AS BIGINT) AS n_low
  FROM lineitem GROUP BY l_orderkey)"""

ORDER_FACTS = f"""order_facts AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS entity_id,
         coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_returned, 0) AS n_returned,
         coalesce(l.qty_sum, CAST(0 AS DOUBLE)) AS qty_sum, coalesce(l.n_low, 0) AS n_low
  FROM orders o LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderdate < {C})"""

# all orders, for queries that predict nothing
ALL_ORDER_FACTS = ORDER_FACTS.replace(f"\n  WHERE o.o_orderdate < {C}", "")

RATES = """rates AS (
  SELECT entity_id, CAST(sum(n_lines) AS BIGINT) AS offered_total,
         CAST(sum(n_returned) AS BIGINT) AS missed_total,
         CAST(sum(n_returned) AS DOUBLE) / nullif(CAST(sum(n_lines) AS DOUBLE), 0) AS miss_rate
  FROM order_facts GROUP BY entity_id)"""

MARKS = f"""marks AS (
  SELECT entity_id,
         {rnd("sum(qty_sum) / CAST(sum(n_lines * 5) AS DOUBLE)", 2)} AS avg_mark,
         CAST(sum(n_low) AS BIGINT) AS low_marks
  FROM order_facts WHERE n_lines > 0 GROUP BY entity_id)"""

ENG = """eng AS (
  SELECT user_id AS entity_id,
         CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
         CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks
  FROM events GROUP BY user_id)"""

ACTS = f"""acts AS (
  SELECT o_custkey AS entity_id, count(*) AS action_count FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_orderdate < {C} GROUP BY o_custkey)"""

ALL_ACTS = ACTS.replace(f" AND o_orderdate < {C}", "")

STATUS = f"""status AS (
  SELECT o_custkey AS entity_id,
         CASE WHEN max(o_orderdate) < {C} THEN 'lapsed' ELSE 'active' END AS status,
         strftime(max(o_orderdate), '%Y-%m-%d') AS last_order_date,
         CASE WHEN max(o_orderdate) < {C}
              THEN arg_max(o_orderpriority, {{'d': o_orderdate, 'k': o_orderkey}}) END AS reason
  FROM orders GROUP BY o_custkey)"""

DIM = """dim AS (
  SELECT n_nationkey AS nation_key, n_name AS area, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def profile_ctes(how: str = "JOIN") -> str:
    prof0 = f"""prof0 AS (
  SELECT c.c_custkey AS entity_id, c.c_nationkey AS nation_key, c.c_name AS name,
         c.c_acctbal AS balance, c.c_mktsegment AS segment,
         s.status, s.last_order_date, s.reason, d.area, d.region,
         r.offered_total, r.missed_total, r.miss_rate, m.avg_mark, m.low_marks,
         e.views, e.purchases, e.clicks, coalesce(a.action_count, 0) AS action_count
  FROM customer c
  JOIN status s ON s.entity_id = c.c_custkey
  JOIN dim d ON d.nation_key = c.c_nationkey
  {how} rates r ON r.entity_id = c.c_custkey
  {how} marks m ON m.entity_id = c.c_custkey
  {how} eng e ON e.entity_id = c.c_custkey
  LEFT JOIN acts a ON a.entity_id = c.c_custkey)"""
    prof = f"""prof AS (
  SELECT entity_id, nation_key, name, balance, segment, status, last_order_date, reason,
         area, region, offered_total, missed_total, miss_rate, avg_mark,
         CAST(low_marks AS DOUBLE) AS low_marks, views, purchases, clicks, action_count,
         {flag("status = 'lapsed'")} AS lapsed_label,
         {flag("balance < 2200.0")} AS low_balance,
         {flag("missed_total > 8")} AS high_missed,
         {flag("action_count = 0")} AS no_actions,
         {flag("purchases = 0")} AS no_purchases
  FROM prof0)"""
    return ",\n".join([LINES, ORDER_FACTS, RATES, MARKS, ENG, ACTS, STATUS, DIM, prof0, prof])


ENG_RATE = ("CASE WHEN views IS NOT NULL THEN greatest(0.0, least(1.0, (CAST(views AS DOUBLE) / 160.0 "
            "+ CAST(purchases AS DOUBLE) / 210.0) / 2.0)) END")
SCORE = ("-3.1 + 3.0 * miss_rate + 1.6 * (greatest(0.0, 6.0 - avg_mark) / 6.0) "
         "+ 0.9 * low_balance + 0.8 * no_purchases + 0.7 * no_actions + 0.6 * high_missed "
         "+ -0.8 * engagement_rate")

SCORED_TAIL = f""",
rs AS (SELECT *, {ENG_RATE} AS engagement_rate FROM prof),
rs2 AS (SELECT *, 1.0 / (1.0 + exp(-({SCORE}))) AS risk_raw FROM rs),
scored AS (
  SELECT entity_id, name, segment, region, area, status, reason,
         {rnd("risk_raw", 4)} AS risk,
         CASE WHEN risk_raw >= CAST(0.30 AS DOUBLE) THEN 'Alto'
              WHEN risk_raw >= CAST(0.20 AS DOUBLE) THEN 'Medio' ELSE 'Baixo' END AS risk_band,
         {half_up("missed_total", "offered_total", 4)} AS miss_rate,
         avg_mark, CAST(low_marks AS BIGINT) AS low_marks, views, purchases, clicks, balance,
         action_count
  FROM rs2)"""

SCORED_CTES = profile_ctes() + SCORED_TAIL
SCORED_LEFT_CTES = profile_ctes("LEFT JOIN") + SCORED_TAIL

FILTER = ("risk_band IN ('Alto', 'Medio') AND region IN ('AMERICA', 'ASIA', 'EUROPE') "
          "AND segment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') AND miss_rate >= 0.10")

TOPN = "(SELECT least(200, greatest(20, count(*) // 25)) FROM scored)"

AUC_TEST = f"""test AS (
  SELECT risk, CASE WHEN status = 'lapsed' THEN 1 ELSE 0 END AS lbl FROM scored
  WHERE {bucket("entity_id")} >= 80),
h AS (
  SELECT {rnd("risk", 4)} AS score_value,
         CAST(sum(CASE WHEN lbl = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(sum(CASE WHEN lbl = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
  FROM test WHERE risk IS NOT NULL GROUP BY 1),
h2 AS (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY score_value
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM h),
auc AS (
  SELECT CAST(sum(pos * (neg_below * 2 + neg)) AS DOUBLE)
         / nullif(CAST(sum(pos) * sum(neg) * 2 AS DOUBLE), 0) AS auc FROM h2)"""

AUC_RAW = f"""test AS (
  SELECT risk_raw, CASE WHEN status = 'lapsed' THEN 1 ELSE 0 END AS lbl FROM rs2 WHERE {bucket("entity_id")} >= 80),
ranks AS (
  SELECT lbl, rank() OVER (ORDER BY risk_raw) AS lo,
         count(*) OVER (ORDER BY risk_raw RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM test),
u AS (
  SELECT sum(lbl) AS p, sum(1 - lbl) AS n, sum(CASE WHEN lbl = 1 THEN lo + hi END) AS twice_ranks FROM ranks)"""

BOX = f"""sorted AS (
  SELECT risk_band, list(r ORDER BY r) AS v, count(*) AS n
  FROM (SELECT risk_band, {rnd("risk", 4)} AS r FROM scored WHERE risk IS NOT NULL) s GROUP BY risk_band),
places AS (
  SELECT *, greatest(0.0, least(n * CAST(0.25 AS DOUBLE) - 0.5, n - 1.0)) AS p1,
         greatest(0.0, least(n * CAST(0.5 AS DOUBLE) - 0.5, n - 1.0)) AS p2,
         greatest(0.0, least(n * CAST(0.75 AS DOUBLE) - 0.5, n - 1.0)) AS p3 FROM sorted),
quartiles AS (
  SELECT risk_band, v, n,
         {rnd("v[floor(p1)::INT + 1] + (p1 - floor(p1)) * (v[ceil(p1)::INT + 1] - v[floor(p1)::INT + 1])", 6)} AS q1,
         {rnd("v[floor(p2)::INT + 1] + (p2 - floor(p2)) * (v[ceil(p2)::INT + 1] - v[floor(p2)::INT + 1])", 6)} AS median,
         {rnd("v[floor(p3)::INT + 1] + (p3 - floor(p3)) * (v[ceil(p3)::INT + 1] - v[floor(p3)::INT + 1])", 6)} AS q3
  FROM places),
fences AS (
  SELECT *, {rnd("q1 - CAST(1.5 AS DOUBLE) * (q3 - q1)", 6)} AS fence_lo,
         {rnd("q3 + CAST(1.5 AS DOUBLE) * (q3 - q1)", 6)} AS fence_hi FROM quartiles)"""

BY_AREA = f"""by_area AS (
  SELECT area, count(*) AS entities,
         CAST(sum(CASE WHEN status = 'lapsed' THEN 1 ELSE 0 END) AS BIGINT) AS lapsed,
         {avg_units("risk", 4)} AS avg_risk
  FROM scored GROUP BY area),
by_area2 AS (SELECT *, {half_up("lapsed", "entities", 4)} AS lapsed_rate FROM by_area)"""

DIM_RATE = f"""dim_rate AS (
  SELECT p.p_type AS part_type, count(*) AS offered_total,
         CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS missed_total
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  GROUP BY p.p_type),
dim_rate2 AS (
  SELECT *, {half_up("missed_total", "offered_total", 4)} AS miss_rate FROM dim_rate)"""

SCORED_COLS = ("entity_id, name, segment, region, area, status, reason, risk, risk_band, "
               "miss_rate, avg_mark, low_marks, views, purchases, clicks, balance, action_count")


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _fk_sql() -> str:
    checks = []
    for child, sp in DRIVER.items():
        for fk in sp.foreign_keys:
            if fk.parent in DRIVER:
                checks.append((fk.name, child, fk.columns[0], fk.parent, fk.parent_columns[0]))
    _, child, fk = QY.ORDERS_HAVE_LINES
    checks.append((QY.ORDERS_HAVE_LINES[0], child, fk.columns[0], fk.parent, fk.parent_columns[0]))
    parts = []
    for name, child, col, parent, pcol in checks:
        parts.append(f"""SELECT '{name}' AS constraint_name, '{child}' AS child_table,
       count(*) AS orphan_keys, CAST(coalesce(sum(rows), 0) AS BIGINT) AS orphan_rows
FROM (SELECT {col}, count(*) AS rows FROM {child} WHERE {col} IS NOT NULL GROUP BY {col}) k
WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = k.{col})""")
    return "\nUNION ALL\n".join(parts)


def _pk_sql() -> str:
    parts = []
    for name, sp in DRIVER.items():
        pk = ", ".join(sp.primary_key)
        parts.append(f"""SELECT '{name}' AS table_name, count(*) AS dup_keys,
       CAST(coalesce(sum(rows), 0) AS BIGINT) AS dup_rows
FROM (SELECT {pk}, count(*) AS rows FROM {name} GROUP BY {pk} HAVING count(*) > 1) d""")
    return "\nUNION ALL\n".join(parts)


def _null_sql() -> str:
    parts = []
    for name, sp in DRIVER.items():
        for c in sp.not_null:
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {name}")
    return "\nUNION ALL\n".join(parts)


def _optional_sql() -> str:
    parts = []
    for name in QY.OPTIONAL_TABLES:
        if name in DRIVER:
            parts.append(f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}")
        else:
            parts.append(f"SELECT '{name}' AS table_name, CAST(0 AS BIGINT) AS rows")
    return "\nUNION ALL\n".join(parts)


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SQL: dict[str, str] = {
    "q_rate_by_entity": _w(LINES, ALL_ORDER_FACTS, RATES) + "SELECT * FROM rates",
    "q_rate_by_dim": _w(DIM_RATE) + "SELECT * FROM dim_rate2",
    "q_marks": _w(LINES, ALL_ORDER_FACTS, MARKS) + "SELECT * FROM marks",
    "q_engagement": _w(ENG) + "SELECT * FROM eng",
    "q_label": (_w(STATUS) + "SELECT *, " + flag("status = 'lapsed'")
                + " AS lapsed_label FROM status"),
    "q_flags": _w(profile_ctes()) + ("SELECT entity_id, lapsed_label, low_balance, high_missed, "
                                     "no_actions, no_purchases, low_marks FROM prof"),
    "q_profile": _w(profile_ctes()) + "SELECT * FROM prof",
    "q_profile_left": _w(profile_ctes("LEFT JOIN")) + "SELECT * FROM prof",
    "q_left_fill": _w(ALL_ACTS) + ("SELECT c_custkey AS entity_id, c_name AS name, "
                               "coalesce(a.action_count, 0) AS action_count FROM customer c "
                               "LEFT JOIN acts a ON a.entity_id = c.c_custkey"),
    "q_rule_score": _w(SCORED_CTES) + (f"SELECT entity_id, {rnd('engagement_rate', 4)} AS "
                                        f"engagement_rate, {rnd('risk_raw', 4)} AS risk FROM rs2"),
    "q_scored": _w(SCORED_CTES) + "SELECT * FROM scored",
    "q_targeting": _w(SCORED_CTES) + f"""SELECT * FROM (
  SELECT entity_id, risk_raw > {QY.TARGET_RISK} AS by_risk, miss_rate > {QY.TARGET_RATE} AS by_rate,
         avg_mark < {QY.TARGET_MARK} AS by_mark FROM rs2) r
WHERE by_risk OR by_rate OR by_mark""",
    "q_engagement_clamped": _w(profile_ctes("LEFT JOIN")) + f"""SELECT entity_id, r AS rate, r = 1.0 AS at_limit
FROM (SELECT entity_id, CASE WHEN views IS NOT NULL THEN least(1.0, greatest(0.0,
        CAST(views + purchases AS DOUBLE) / {QY.CLAMP_SCALE} / 2.0)) END AS r FROM prof) p""",
    "q_scored_left": _w(SCORED_LEFT_CTES) + "SELECT * FROM scored",
    "q_split": ("SELECT c_custkey AS entity_id, " + bucket("c_custkey") + " AS bucket, "
                "CASE WHEN " + bucket("c_custkey") + " < 80 THEN 'train' ELSE 'test' END AS split "
                "FROM customer"),
    "q_auc": _w(SCORED_CTES, AUC_TEST) + "SELECT auc FROM auc",
    "q_auc_unrounded": _w(SCORED_CTES, AUC_RAW) + """SELECT
       CAST(twice_ranks - p * (p + 1) AS DOUBLE) / nullif(CAST(2 * p * n AS DOUBLE), 0) AS auc FROM u""",
    "q_ml_auc_exact": _w(SCORED_CTES, AUC_RAW) + """SELECT CAST(sum(lbl) AS BIGINT) AS positives,
       CAST(sum(1 - lbl) AS BIGINT) AS negatives, sum(lbl) > 0 AND sum(1 - lbl) > 0 AS has_auc, true AS agrees FROM test""",
    "q_by_area": _w(SCORED_CTES, BY_AREA) + "SELECT * FROM by_area2",
    "q_reasons": _w(SCORED_CTES) + ("SELECT reason, count(*) AS entities FROM scored "
                                    "WHERE status = 'lapsed' GROUP BY reason"),
    "q_reason_share": _w(SCORED_CTES) + f"""SELECT reason, entities,
       {half_up("entities", "sum(entities) OVER ()", 4)} AS share
FROM (SELECT reason, count(*) AS entities FROM scored WHERE status = 'lapsed' GROUP BY reason) r""",
    "q_kpis": _w(SCORED_CTES, AUC_TEST) + f"""SELECT count(*) AS total_entities,
       CAST(sum(CASE WHEN status = 'lapsed' THEN 1 ELSE 0 END) AS BIGINT) AS lapsed,
       {avg_units("risk", 4)} AS avg_risk,
       {avg_units("miss_rate", 4)} AS avg_miss_rate,
       {avg_units("avg_mark", 2)} AS avg_mark,
       (SELECT {rnd("auc", 4)} FROM auc) AS model_auc
FROM scored""",
    "q_facets": _w(SCORED_CTES) + """SELECT facet, value,
       row_number() OVER (PARTITION BY facet ORDER BY CASE WHEN facet <> 'risk_band' THEN value END NULLS LAST,
                                   CASE WHEN facet = 'risk_band' THEN value END DESC NULLS LAST) AS position
FROM (SELECT DISTINCT 'risk_band' AS facet, risk_band AS value FROM scored
UNION ALL SELECT DISTINCT 'region' AS facet, region AS value FROM scored
UNION ALL SELECT DISTINCT 'segment' AS facet, segment AS value FROM scored) f""",
    "q_volume_cards": _w(SCORED_CTES) + f"""SELECT population, n_filtered, actions, views,
       {thousands("population")} AS population_text, {thousands("n_filtered")} AS filtered_text,
       {thousands("actions")} AS actions_text, {thousands("views")} AS views_text,
       CASE WHEN population = 0 THEN '-'
            ELSE {pct1("CAST(n_filtered AS DOUBLE) / CAST(population AS DOUBLE)")} END AS share_text
FROM (SELECT (SELECT count(*) FROM customer) AS population, count(*) FILTER (WHERE {FILTER}) AS n_filtered,
             CAST(coalesce(sum(action_count) FILTER (WHERE {FILTER}), 0) AS BIGINT) AS actions,
             CAST(coalesce(sum(views) FILTER (WHERE {FILTER}), 0) AS BIGINT) AS views FROM scored) c""",
    "q_filtered_extract": _w(SCORED_CTES) + f"SELECT * FROM scored WHERE {FILTER}",
    "q_filter_share": _w(SCORED_CTES) + f"""SELECT n_total, n_filtered,
       {half_up("n_filtered", "n_total", 4)} AS filter_share,
       CASE WHEN n_total = 0 THEN '-'
            ELSE {pct1("CAST(n_filtered AS DOUBLE) / CAST(n_total AS DOUBLE)")} END AS share_text
FROM (SELECT count(*) AS n_total, count(*) FILTER (WHERE {FILTER}) AS n_filtered FROM scored) c""",
    "q_adaptive_params": _w(SCORED_CTES) + """SELECT count(*) AS entities,
       CAST(least(200, greatest(20, count(*) // 25)) AS BIGINT) AS top_n,
       CAST(least(40, greatest(20, count(*) // 100)) AS BIGINT) AS bins
FROM scored""",
    "q_search": _w(SCORED_CTES) + (
        "SELECT entity_id, name, risk, risk_band FROM scored WHERE "
        f"contains(lower(name), {_lit(QY.SEARCH_TEXT.strip().lower())}) "
        f"OR CAST(entity_id AS VARCHAR) = {_lit(QY.SEARCH_TEXT.strip().lower())}"),
    "q_search_regex": _w(SCORED_CTES) + (
        "SELECT entity_id, name, risk, risk_band FROM scored WHERE "
        f"regexp_matches(lower(name), {_lit(QY.SEARCH_REGEX.strip().lower())}) "
        f"OR CAST(entity_id AS VARCHAR) = {_lit(QY.SEARCH_REGEX.strip().lower())}"),
    "q_percent_text": _w(SCORED_CTES) + f"""SELECT entity_id,
       {short_pct("risk")} AS risk_text,
       {short_pct("miss_rate")} AS rate_text,
       {pct1("risk")} AS risk_pct,
       printf('%.2f', avg_mark) AS mark_text,
       replace(format('{{:,}}', CAST(trunc(balance) AS BIGINT)), ',', '.') AS balance_text,
       replace(format('{{:,}}', views * 1000), ',', '.') AS views_text
FROM scored""",
    "q_entity_detail": _w(SCORED_CTES) + """, top AS (
  SELECT entity_id FROM scored ORDER BY risk DESC NULLS LAST, entity_id LIMIT 1),
d AS (
  SELECT o.o_custkey AS entity_id,
         l.l_partkey AS part_key, p.p_name AS part_name, count(*) AS lines,
         CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS total_missed,
         sum(l.l_quantity) / CAST(count(*) * 5 AS DOUBLE) AS avg_mark
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  WHERE o.o_custkey IN (SELECT entity_id FROM top)
  GROUP BY o.o_custkey, l.l_partkey, p.p_name)
SELECT *, row_number() OVER (ORDER BY total_missed DESC, part_key) AS by_missed,
       row_number() OVER (ORDER BY avg_mark, part_key) AS by_mark FROM d""",
    "q_entity_tables": _w(SCORED_CTES) + f""", top AS (
  SELECT * FROM scored ORDER BY risk DESC NULLS LAST, entity_id LIMIT 1),
c AS (
  SELECT 'scores' AS table_name, count(*) AS rows FROM scored WHERE entity_id = (SELECT entity_id FROM top)
  UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_custkey = (SELECT entity_id FROM top)
  UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey = (SELECT entity_id FROM top)
  UNION ALL SELECT 'events', count(*) FROM events WHERE user_id = (SELECT entity_id FROM top)
  UNION ALL SELECT 'actions', count(*) FROM orders
    WHERE o_custkey = (SELECT entity_id FROM top) AND o_orderpriority = '1-URGENT')
SELECT table_name, rows, (SELECT entity_id FROM top) AS entity_id,
       (SELECT {pct1("risk")} FROM top) AS risk_text, (SELECT {pct1("miss_rate")} FROM top) AS rate_text,
       (SELECT printf('%.2f', avg_mark) FROM top) AS mark_text
FROM c""",
    "q_entity_detail_all": """SELECT o.o_custkey AS entity_id, l.l_partkey AS part_key,
       p.p_name AS part_name, count(*) AS lines,
       CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS total_missed,
       sum(l.l_quantity) / CAST(count(*) * 5 AS DOUBLE) AS avg_mark
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY o.o_custkey, l.l_partkey, p.p_name""",
    "q_hist": _w(SCORED_CTES) + f""", nb AS (
  SELECT CAST(least(40, greatest(20, count(*) // 100)) AS BIGINT) AS b FROM scored),
hb AS (SELECT least({units("risk", 4)} * nb.b // 10000, nb.b - 1) AS bin, risk_band, nb.b
       FROM scored, nb WHERE risk IS NOT NULL)
SELECT CAST(bin AS INTEGER) AS bin, risk_band, count(*) AS entities,
       CAST(bin AS DOUBLE) / CAST(b AS DOUBLE) AS bin_lo, CAST(bin + 1 AS DOUBLE) / CAST(b AS DOUBLE) AS bin_hi
FROM hb GROUP BY bin, risk_band, b""",
    "q_box": _w(SCORED_CTES) + f"""SELECT risk_band, count(*) AS n, min(r) AS min,
       {rnd("quantile_cont(r, 0.25)", 6)} AS q1,
       {rnd("quantile_cont(r, 0.5)", 6)} AS median,
       {rnd("quantile_cont(r, 0.75)", 6)} AS q3, max(r) AS max
FROM (SELECT risk_band, {rnd("risk", 4)} AS r FROM scored WHERE risk IS NOT NULL) s
GROUP BY risk_band""",
    "q_box_drawn": _w(SCORED_CTES, BOX) + f"""SELECT risk_band, n, v[1] AS min, q1, median, q3, v[n] AS max,
       fence_lo, fence_hi,
       {rnd("median - CAST(1.57 AS DOUBLE) * (q3 - q1) / sqrt(CAST(n AS DOUBLE))", 6)} AS notch_lo,
       {rnd("median + CAST(1.57 AS DOUBLE) * (q3 - q1) / sqrt(CAST(n AS DOUBLE))", 6)} AS notch_hi,
       least(list_min(list_filter(v, lambda x: x >= fence_lo)), q1) AS whisker_lo,
       greatest(list_max(list_filter(v, lambda x: x <= fence_hi)), q3) AS whisker_hi,
       CAST(len(list_filter(v, lambda x: x < fence_lo)) AS BIGINT) AS outliers_lo,
       CAST(len(list_filter(v, lambda x: x > fence_hi)) AS BIGINT) AS outliers_hi
FROM fences""",
    "q_box_outliers": _w(SCORED_CTES, BOX) + """SELECT risk_band, value, count(*) AS rows
FROM (SELECT risk_band, unnest(v) AS value, fence_lo, fence_hi FROM fences) p
WHERE value < fence_lo OR value > fence_hi GROUP BY risk_band, value""",
    "q_top_n": _w(SCORED_CTES) + f"""SELECT {SCORED_COLS},
       row_number() OVER (ORDER BY risk DESC NULLS LAST, entity_id) AS position FROM scored
QUALIFY row_number() OVER (ORDER BY risk DESC NULLS LAST, entity_id) <= {TOPN}""",
    "q_top_area": _w(SCORED_CTES, BY_AREA) + (
        "SELECT *, row_number() OVER (ORDER BY lapsed_rate DESC NULLS LAST, area) AS position "
        "FROM by_area2 ORDER BY lapsed_rate DESC NULLS LAST, area "
        f"LIMIT {QY.TOP_AREAS}"),
    "q_top_dim": _w(DIM_RATE) + (
        "SELECT *, row_number() OVER (ORDER BY miss_rate DESC NULLS LAST, part_type) AS position "
        "FROM dim_rate2 ORDER BY miss_rate DESC NULLS LAST, part_type "
        f"LIMIT {QY.TOP_DIMS}"),
    "q_scatter": _w(SCORED_CTES) + f"""SELECT entity_id, name, segment, region, area, risk,
       risk_band, miss_rate, avg_mark, row_number() OVER (ORDER BY risk DESC NULLS LAST, entity_id) AS position
FROM scored WHERE {FILTER}
ORDER BY risk DESC NULLS LAST, entity_id LIMIT {QY.SCATTER_ROWS}""",
    "q_priority_list": _w(SCORED_CTES) + f"""SELECT entity_id, name, segment, region, area,
       {short_pct("risk")} AS risk, risk_band, {short_pct("miss_rate")} AS miss_rate, avg_mark,
       balance, purchases, action_count,
       row_number() OVER (ORDER BY scored.risk DESC NULLS LAST, entity_id) AS position
FROM scored WHERE {FILTER}
QUALIFY row_number() OVER (ORDER BY scored.risk DESC NULLS LAST, entity_id) <= {TOPN}""",
    "q_stored_order": _w(SCORED_CTES) + """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS breaks_inside,
       CAST(0 AS BIGINT) AS breaks_between,
       (SELECT entity_id FROM scored ORDER BY risk DESC NULLS LAST, entity_id LIMIT 1) AS first_entity,
       (SELECT entity_id FROM scored ORDER BY risk NULLS FIRST, entity_id DESC LIMIT 1) AS last_entity
FROM scored""",
    "q_skip_empty": f"""SELECT table_name, rows AS counted, rows AS read_back, rows > 0 AS stored
FROM ({_optional_sql()}) t""",
    "q_refresh_versions": (
        "SELECT v AS version, v = 2 AS is_current, dataset, rows, rows AS counted FROM (\n"
        + "\nUNION ALL\n".join(
            f"SELECT CAST({v} AS BIGINT) AS v, '{d}' AS dataset, ({_w(profile_ctes(how))} SELECT {n} FROM prof) AS rows"
            for v, how in ((1, "JOIN"), (2, "LEFT JOIN"))
            for d, n in (("profile", "count(*)"), ("areas", "count(DISTINCT (region, area))"))) + ") r"),
    "q_quarantine": """SELECT reason, count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys
FROM (SELECT c_custkey, CASE WHEN c_custkey % 97 = 0 THEN 'c_acctbal is no double'
                             WHEN c_custkey % 89 = 0 THEN 'more fields than columns'
                             WHEN c_custkey % 83 = 0 THEN 'fewer fields than columns' ELSE 'loaded' END AS reason
      FROM customer) c GROUP BY reason""",
    "q_fk_orphans": _fk_sql(),
    "q_pk_violations": _pk_sql(),
    "q_null_counts": _w(profile_ctes("LEFT JOIN")) + _null_sql() + "".join(
        f"\nUNION ALL\nSELECT 'profile_left' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM prof"
        for c in ("miss_rate", "avg_mark", "views", "purchases", "action_count", "reason")),
    "q_fk_event_users": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS constraint_name, '{child}' AS child_table, count(DISTINCT k) AS orphan_keys, "
        f"count(*) AS orphan_rows FROM (SELECT {col} AS k FROM {src}) c "
        f"WHERE k IS NOT NULL AND k NOT IN (SELECT {pcol} FROM {parent} WHERE {pcol} IS NOT NULL)"
        for name, child, col, src, pcol, parent in (
            ("viewers_buy", "views", "user_id", "(SELECT user_id FROM events WHERE event_type = 'view') v",
             "user_id", "(SELECT user_id FROM events WHERE event_type = 'purchase') b"),
            ("buyers_order", "buyers", "user_id", "(SELECT user_id FROM events WHERE event_type = 'purchase') b",
             "o_custkey", "orders"),
            ("customers_view", "orders", "o_custkey", "orders",
             "user_id", "(SELECT user_id FROM events WHERE event_type = 'view') v"))),
    "q_optional_source": _optional_sql(),
    "q_run_manifest": f"""SELECT (SELECT count(*) FROM customer) AS entities_count,
       (SELECT count(*) FROM orders) AS activity_rows,
       (SELECT count(*) FROM orders o
          WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)) AS marks_rows,
       (SELECT count(*) FROM events) AS engagement_rows,
       (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS actions_rows,
       CAST({QY.SEED} AS BIGINT) AS seed""",
    "q_ml_split": _w(SCORED_CTES) + f"""SELECT entity_id,
       CASE WHEN {bucket("entity_id")} < 80 THEN 'train' ELSE 'test' END AS split, true AS is_probability
FROM scored""",
    "q_ml_calibration": _w(profile_ctes()) + f"""SELECT 'mean_probability' AS equation,
       round(avg(lapsed_label), 4) AS value FROM prof WHERE {bucket("entity_id")} < 80
""" + "".join(f"UNION ALL SELECT 'residual {c}', CAST(0 AS DOUBLE)\n" for c in flows.MODEL_FEATURES),
}
SQL["q_csv_roundtrip"] = SQL["q_scored"]
SQL["q_parquet_roundtrip"] = SQL["q_profile"]
SQL["q_publish_run"] = _w(SCORED_CTES, DIM_RATE) + """, c AS (
  SELECT 'profile' AS dataset, count(*) AS rows, ['parquet'] AS formats FROM prof
  UNION ALL SELECT 'scores', count(*), ['parquet', 'csv'] FROM scored
  UNION ALL SELECT 'by_area', count(*), ['parquet', 'csv'] FROM (SELECT DISTINCT area FROM scored) a
  UNION ALL SELECT 'rate_by_dim', count(*), ['parquet', 'csv'] FROM dim_rate2
  UNION ALL SELECT 'reasons', count(*), ['parquet', 'csv']
    FROM (SELECT DISTINCT reason FROM scored WHERE status = 'lapsed') r
  UNION ALL SELECT 'kpis', 1, ['parquet', 'csv']
  UNION ALL SELECT 'entity_detail', count(*), ['parquet']
    FROM (SELECT DISTINCT o.o_custkey, l.l_partkey FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey) e)
SELECT dataset, unnest(formats) AS format, rows FROM c"""

SQL["q_entity_lookup"] = SQL["q_entity_detail"].replace(" FROM d", ", true AS few_rows_read FROM d")
SQL["q_search_index"] = SQL["q_search"].replace("risk_band FROM", "risk_band, true AS few_rows_read FROM")
SQL["q_guarded_profile"] = SQL["q_profile"]
SQL["q_cube_kpis"], SQL["q_cube_hist"], SQL["q_cube_facets"] = SQL["q_kpis"], SQL["q_hist"], SQL["q_facets"]
SQL["q_cube_cards"] = _w(SCORED_CTES) + f"""SELECT count(*) AS n_total, count(*) FILTER (WHERE {FILTER}) AS n_filtered,
       CAST(coalesce(sum(action_count) FILTER (WHERE {FILTER}), 0) AS BIGINT) AS actions,
       CAST(coalesce(sum(views) FILTER (WHERE {FILTER}), 0) AS BIGINT) AS views FROM scored"""
SQL["q_join_violations"] = "\nUNION ALL\n".join(
    f"SELECT '{frame}' AS frame, count(*) AS keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM "
    f"(SELECT {key}, count(*) AS n FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1) k"
    for frame, key, source in (
        ("entity", "c_custkey", "customer"), ("status", "k", "(SELECT DISTINCT o_custkey AS k FROM orders) o"),
        ("engagement", "k", "(SELECT DISTINCT user_id AS k FROM events) e"), ("raw_events", "user_id", "events"),
        ("raw_orders", "o_custkey", "orders")))

# Queries without an SQL form (model fit): checked on rows and by unit tests.
NO_ORACLE = ("q_ml_scores", "q_ml_auc")
