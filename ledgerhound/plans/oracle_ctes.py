"""Independent SQL (DuckDB dialect) for the same ledgers and operators.

These statements are the correctness oracle over the raw driver tables. The
rules are stated candidate by candidate, from their description: for each moment
at which a rule could fire, a lateral aggregate over the customer's or account's
own rows says what happened around it. Neither windows nor the Spark plans'
pre-aggregation appear here, so agreement means something.

``with_ctes(body, *names)`` prefixes ``body`` with the named CTEs and their
dependencies in definition order.
"""

from __future__ import annotations

from ..operators.rules import detail_prefix, detail_suffix
from ..params import FIXTURE_RULES as R
from ..params import FIXTURE_SPLIT as S
from ..params import RuleParams

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    _CTES[name] = (sql, deps)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_CTES[n][0]})" for n in order) + "\n" + body


K = r"CAST(regexp_extract(e.props, '\"k\":\s*(-?[0-9]+)', 1) AS BIGINT)"

cte("evt", f"""
SELECT 'E' || CAST(e.event_id AS VARCHAR) AS txn_id,
       CAST(date_diff('day', DATE '2024-01-01', CAST(e.ts AS DATE)) AS INTEGER) AS date_key,
       e.user_id * 2 + e.event_id % 2 AS account_key,
       e.user_id AS customer_key,
       COALESCE(n.n_name, 'UNK') AS counterparty_country,
       'P' || CAST({K} AS VARCHAR) AS counterparty_id,
       CAST(hour(e.ts) AS INTEGER) AS hour_of_day,
       CAST(ROUND(e.value * 100, 2) AS DECIMAL(18,2)) AS amount_cad,
       CASE WHEN {K} % 2 = 0 THEN 'credit' ELSE 'debit' END AS direction,
       CASE e.event_type WHEN 'purchase' THEN 'cash' WHEN 'signup' THEN 'wire' WHEN 'click' THEN 'emt'
                         WHEN 'error' THEN 'cheque' WHEN 'view' THEN 'pos' END AS channel
FROM events e LEFT JOIN nation n ON n.n_nationkey = e.event_id % (SELECT COUNT(*) FROM nation)""")

cte("dim_country", """
SELECT n_name AS country_code,
       CASE WHEN n_regionkey = 3 THEN 'high_risk' ELSE 'standard' END AS risk_tier,
       CASE WHEN n_regionkey = 3 THEN 1 ELSE 0 END AS is_high_risk
FROM nation
UNION ALL SELECT 'UNK', 'standard', 0""")

cte("lin_j", """
SELECT l.*, o.o_custkey, n.n_name
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey""")

INGEST = ("l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, "
          "l_discount, l_tax, l_returnflag, l_linestatus")

cte("stg", f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS txn_id,
       CASE WHEN l_partkey % 499 = 1 THEN 'A9999999' ELSE 'A' || CAST(o_custkey AS VARCHAR) END AS account_id,
       'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS day_index,
       8 + l_linenumber AS hour,
       CASE WHEN l_partkey % 997 = 0 THEN -CAST(l_extendedprice AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount_cad,
       CASE WHEN l_returnflag = 'R' THEN 'debit' ELSE 'credit' END AS direction,
       CASE WHEN l_linestatus = 'F' THEN 'cash' ELSE 'wire' END AS channel,
       CASE WHEN l_linestatus = 'O' AND l_partkey % 33 = 0 THEN NULL
            WHEN l_suppkey % 50 = 0 THEN lower(n_name) || ' ' ELSE n_name END AS counterparty_country,
       'P' || CAST(l_suppkey AS VARCHAR) AS counterparty_id,
       CAST(l_shipdate AS DATE) AS txn_date,
       {INGEST}
FROM lin_j""", ("lin_j",))

cte("dedup", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY txn_id ORDER BY {INGEST}) AS rn FROM stg) WHERE rn = 1""", ("stg",))

cte("stg_customers", """
SELECT c.c_custkey AS source_key, 'C' || CAST(c.c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c.c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'business' ELSE 'personal' END AS customer_segment,
       lower(c.c_mktsegment) AS occupation_or_business_type,
       CAST(c.c_custkey * 37 % 120 AS INTEGER) AS tenure_months,
       CASE WHEN c.c_custkey % 10 <= 6 THEN 'low' WHEN c.c_custkey % 10 <= 8 THEN 'medium' ELSE 'high' END AS kyc_risk_rating,
       CASE WHEN c.c_custkey % 67 = 0 THEN 'True' ELSE 'False' END AS is_pep,
       (c.c_acctbal + 1000) * 10 AS declared_annual_income_cad,
       r.r_name AS home_province,
       CASE c.c_custkey % 4 WHEN 0 THEN 'branch' WHEN 1 THEN 'online' WHEN 2 THEN 'mobile' ELSE 'advisor' END AS onboarding_channel
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")

# The tenure bands, from and up to how many months.
cte("tenure_bands", "SELECT * FROM (VALUES ('00-11m', 0, 12), ('12-35m', 12, 36), ('36-83m', 36, 84), ('84m+', 84, 100000)) AS b(tenure_band, low, high)")

cte("banded_customer", """
SELECT s.* EXCLUDE (is_pep), b.tenure_band, CAST(s.occupation_or_business_type = 'machinery' AS INTEGER) AS is_cash_intensive_business,
       CAST(lower(s.is_pep) = 'true' OR s.is_pep = '1' AS INTEGER) AS is_pep, dense_rank() OVER (ORDER BY s.customer_id) AS place
FROM stg_customers s JOIN tenure_bands b ON s.tenure_months >= b.low AND s.tenure_months < b.high""", ("stg_customers", "tenure_bands"))

cte("dim_customer", "SELECT place AS customer_key, * EXCLUDE (place, source_key) FROM banded_customer", ("banded_customer",))

cte("evt_customer", "SELECT source_key AS customer_key, * EXCLUDE (place, source_key) FROM banded_customer", ("banded_customer",))

cte("stg_accounts", """
SELECT 'A' || CAST(c_custkey AS VARCHAR) AS account_id, 'C' || CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE c_custkey % 3 WHEN 0 THEN 'chequing' WHEN 1 THEN 'savings' ELSE 'business' END AS account_type,
       CAST(c_custkey * 53 % 3000 AS INTEGER) AS opened_days_ago
FROM customer""")

cte("dim_account", """
SELECT dense_rank() OVER (ORDER BY account_id) AS account_key, account_id,
       (SELECT min(customer_key) FROM dim_customer c WHERE c.customer_id = s.customer_id) AS customer_key, account_type, opened_days_ago
FROM stg_accounts s WHERE customer_id IN (SELECT customer_id FROM dim_customer)""", ("stg_accounts", "dim_customer"))

cte("evt_account", """
SELECT c_custkey * 2 + s.slot AS account_key, 'A' || CAST(c_custkey * 2 + s.slot AS VARCHAR) AS account_id,
       c_custkey AS customer_key,
       CASE (c_custkey * 2 + s.slot) % 3 WHEN 0 THEN 'chequing' WHEN 1 THEN 'savings' ELSE 'business' END AS account_type,
       CAST((c_custkey * 2 + s.slot) * 53 % 3000 AS INTEGER) AS opened_days_ago
FROM customer, (VALUES (0), (1)) AS s(slot)""")

cte("rejected", """
SELECT txn_id, if(amount_cad <= 0, 'negative_amount', 'orphan_account_id') AS reject_reason,
       if(amount_cad <= 0, concat('amount_cad=', amount_cad), concat('account_id=', account_id)) AS raw_payload
FROM dedup
WHERE amount_cad <= 0 OR (amount_cad > 0 AND account_id NOT IN (SELECT account_id FROM dim_account))""", ("dedup", "dim_account"))

cte("fact", """
WITH kept AS (
  SELECT *, coalesce(upper(trim(counterparty_country)), 'UNK') AS place, if(direction = 'credit', 1, -1) AS way
  FROM dedup WHERE amount_cad > 0),
owners AS (SELECT customer_id, customer_key FROM dim_customer),
accounts AS (SELECT account_id, account_key FROM dim_account)
SELECT txn_id, day_index AS date_key, account_key, customer_key,
       if(place IN (SELECT country_code FROM dim_country), place, 'UNK') AS counterparty_country, counterparty_id,
       hour AS hour_of_day, amount_cad, direction, channel, CAST(way * amount_cad AS DECIMAL(18,2)) AS signed_amount_cad
FROM kept JOIN accounts USING (account_id) JOIN owners USING (customer_id)""", ("dedup", "dim_account", "dim_customer", "dim_country"))

cte("dim_date", """
SELECT DISTINCT day_index AS date_key, txn_date AS calendar_date,
       CAST(year(txn_date) AS INTEGER) AS year, CAST(month(txn_date) AS INTEGER) AS month,
       CAST(dayofweek(txn_date) AS INTEGER) AS day_of_week,
       CASE WHEN dayofweek(txn_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       strftime(txn_date, '%b') AS month_name
FROM stg WHERE day_index IS NOT NULL""", ("stg",))

cte("evt_date", """
SELECT DISTINCT date_key, CAST(DATE '2024-01-01' + date_key AS DATE) AS calendar_date,
       CAST(year(DATE '2024-01-01' + date_key) AS INTEGER) AS year,
       CAST(month(DATE '2024-01-01' + date_key) AS INTEGER) AS month,
       CAST(dayofweek(DATE '2024-01-01' + date_key) AS INTEGER) AS day_of_week,
       CASE WHEN dayofweek(DATE '2024-01-01' + date_key) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       strftime(DATE '2024-01-01' + date_key, '%b') AS month_name
FROM evt""", ("evt",))

cte("sup", f"""
SELECT txn_id, date_key, account_key, customer_key, counterparty_country, counterparty_id, hour_of_day,
       amount_cad, direction, channel
FROM (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS txn_id,
         CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS date_key,
         l_suppkey AS account_key, l_suppkey AS customer_key, n_name AS counterparty_country,
         'P' || CAST(o_custkey AS VARCHAR) AS counterparty_id, 8 + l_linenumber AS hour_of_day,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_cad,
         CASE WHEN l_returnflag = 'R' THEN 'debit' ELSE 'credit' END AS direction,
         CASE WHEN l_linestatus = 'F' THEN 'cash' ELSE 'wire' END AS channel,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {INGEST}) AS rn
  FROM lin_j) WHERE rn = 1""", ("lin_j",))


# ----------------------------------------------------------------- rules

def _sql_text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _alert_rows(rule: str, p: RuleParams, found: str, amount: str, count: str, figure: str) -> str:
    """Alerts of the candidates in ``found``, one for each customer and day: the largest figures of that day."""
    pre, post = _sql_text(detail_prefix(rule, p)), _sql_text(detail_suffix(rule, p))
    return f"""
SELECT concat_ws('-', '{rule}', customer_key, date_key) AS alert_id, '{rule}' AS rule_id, customer_key, date_key,
       CAST({amount} AS DOUBLE) AS trigger_amount, CAST({count} AS BIGINT) AS trigger_txn_count,
       concat({pre}, {figure}, {post}) AS detail
FROM ({found}) GROUP BY customer_key, date_key"""


def _whole(number: str) -> str:
    return f"concat(CAST(round({number}) AS DECIMAL(38,0)), '.0')"


def _burst(rule: str, p: RuleParams, src: str, rows: str, clock: str, span: int, keep: str, figure: str) -> str:
    """Candidates are the moments of the picked rows; what counts is the customer's picked rows of the ``span`` up to then."""
    picked = f"(SELECT customer_key, date_key, {clock} AS moment, amount_cad FROM {src} WHERE {rows})"
    found = f"""
  SELECT m.customer_key, m.date_key, around.n, around.total
  FROM (SELECT DISTINCT customer_key, date_key, moment FROM {picked}) m,
       LATERAL (SELECT count(*) AS n, sum(x.amount_cad) AS total, max(x.amount_cad) AS largest FROM {picked} x
                WHERE x.customer_key = m.customer_key AND x.moment <= m.moment AND x.moment > m.moment - {span}) around
  WHERE {keep}"""
    return _alert_rows(rule, p, found, "max(total)", "max(n)", figure)


_HOUR = "24 * date_key + hour_of_day"


def rule_sql(rule: str, src: str, p: RuleParams = R) -> str:
    cash_in = "channel = 'cash' AND direction = 'credit'"
    if rule == "R001":
        return _burst(rule, p, src, f"{cash_in} AND amount_cad >= {p.r001_band_low} AND amount_cad <= {p.band_high}", _HOUR,
                      p.r001_hours, f"n >= {p.r001_min_count}", "max(n)")
    if rule == "R002":
        return _burst(rule, p, src, cash_in, _HOUR, p.r002_hours,
                      f"n >= {p.r002_min_count} AND total >= {p.r002_threshold} AND largest < {p.r002_threshold}", _whole("max(total)"))
    if rule == "R006":
        return _burst(rule, p, src, f"channel IN {p.r006_channels} AND amount_cad >= {p.r006_min_amount} AND amount_cad % {p.r006_unit} = 0",
                      _HOUR, p.r006_hours, f"n >= {p.r006_min_count}", "max(n)")
    if rule == "R008":
        return _burst(rule, p, src, f"{cash_in} AND amount_cad >= {p.band_low} AND amount_cad <= {p.band_high}", "date_key",
                      p.r008_days, f"n >= {p.r008_min_count}", "max(n)")
    if rule == "R003":
        found = f"""
  SELECT big.customer_key, big.date_key, big.amount_cad AS came, gone.amount AS went, gone.n
  FROM (SELECT *, {_HOUR} AS moment FROM {src} WHERE direction = 'credit' AND amount_cad >= {p.r003_min_credit}) big,
       LATERAL (SELECT coalesce(sum(o.amount_cad), 0) AS amount, count(*) AS n FROM {src} o
                WHERE o.direction = 'debit' AND o.account_key = big.account_key
                  AND 24 * o.date_key + o.hour_of_day BETWEEN big.moment + 1 AND big.moment + {p.r003_hours}) gone
  WHERE went >= {p.r003_ratio} * came"""
        return _alert_rows(rule, p, found, "max(came)", "max(n)", _whole("100.0 * CAST(max(went) AS DOUBLE) / CAST(max(came) AS DOUBLE)"))
    if rule == "R004":
        found = f"""
  SELECT customer_key, date_key, amount_cad, counterparty_country FROM {src}
  WHERE channel = 'wire' AND amount_cad >= {p.r004_min_amount}
    AND counterparty_country IN (SELECT country_code FROM dim_country WHERE is_high_risk = 1)"""
        return _alert_rows(rule, p, found, "sum(amount_cad)", "count(*)", "array_to_string(list_sort(list_distinct(list(counterparty_country))), ',')")
    if rule == "R005":
        days = f"(SELECT customer_key, date_key, sum(if(direction = 'credit', amount_cad, 0)) AS credits FROM {src} GROUP BY ALL)"
        found = f"""
  SELECT d.customer_key, d.date_key, around.recent, CAST(around.earlier AS DOUBLE) / around.n * {float(p.r005_window_days)} AS usual
  FROM {days} d, LATERAL (
    SELECT sum(o.credits) FILTER (o.date_key > d.date_key - {p.r005_window_days}) AS recent,
           sum(o.credits) FILTER (o.date_key <= d.date_key - {p.r005_baseline_to}) AS earlier,
           count(*) FILTER (o.date_key <= d.date_key - {p.r005_baseline_to}) AS n
    FROM {days} o WHERE o.customer_key = d.customer_key AND o.date_key BETWEEN d.date_key - {p.r005_baseline_from} AND d.date_key) around
  WHERE around.n >= {p.r005_min_baseline_days} AND usual > 0 AND CAST(recent AS DOUBLE) > {p.r005_multiplier} * usual
    AND recent > {p.r005_min_volume}"""
        return _alert_rows(rule, p, found, "max(recent)", "NULL", "round(CAST(max(recent) AS DOUBLE) / max(usual), 1)")
    if rule == "R007":
        days = f"(SELECT account_key, customer_key, date_key, sum(amount_cad) AS moved FROM {src} GROUP BY ALL)"
        found = f"""
  SELECT d.customer_key, d.date_key, d.date_key - before.last AS gap, after.moved
  FROM {days} d,
       LATERAL (SELECT max(o.date_key) AS last FROM {days} o
                WHERE o.account_key = d.account_key AND (o.date_key, o.customer_key) < (d.date_key, d.customer_key)) before,
       LATERAL (SELECT sum(o.moved) AS moved FROM {days} o
                WHERE o.account_key = d.account_key AND o.date_key >= d.date_key AND o.date_key < d.date_key + {p.r007_window_days}) after
  WHERE gap >= {p.r007_gap_days} AND after.moved >= {p.r007_min_volume}"""
        return _alert_rows(rule, p, found, "max(moved)", "NULL", "max(gap)")
    raise KeyError(rule)


def detection_sql(rule: str, src: str, p: RuleParams = R) -> str:
    """R003 and R007 dated at the moment at which their condition becomes true: every later moment is a candidate, the first one that does it counts."""
    if rule == "R003":
        found = f"""
  SELECT customer_key, moment // 24 AS date_key, came, went, n FROM (
    SELECT big.customer_key, big.nth, big.amount_cad AS came, hit.moment, gone.amount AS went, gone.n,
           row_number() OVER (PARTITION BY big.nth ORDER BY hit.moment) AS first
    FROM (SELECT *, {_HOUR} AS moment, row_number() OVER () AS nth FROM {src} WHERE direction = 'credit' AND amount_cad >= {p.r003_min_credit}) big,
         LATERAL (SELECT DISTINCT {_HOUR} AS moment FROM {src} o WHERE o.direction = 'debit' AND o.account_key = big.account_key
                    AND {_HOUR} BETWEEN big.moment + 1 AND big.moment + {p.r003_hours}) hit,
         LATERAL (SELECT sum(o.amount_cad) AS amount, count(*) AS n FROM {src} o
                  WHERE o.direction = 'debit' AND o.account_key = big.account_key
                    AND 24 * o.date_key + o.hour_of_day BETWEEN big.moment + 1 AND hit.moment) gone
    WHERE gone.amount >= {p.r003_ratio} * big.amount_cad) WHERE first = 1"""
        return _alert_rows(rule, p, found, "max(came)", "max(n)", _whole("100.0 * CAST(max(went) AS DOUBLE) / CAST(max(came) AS DOUBLE)"))
    days = f"(SELECT account_key, customer_key, date_key, sum(amount_cad) AS moved FROM {src} GROUP BY ALL)"
    found = f"""
  SELECT customer_key, day AS date_key, gap, moved FROM (
    SELECT d.customer_key, d.date_key - before.last AS gap, hit.day, after.moved,
           row_number() OVER (PARTITION BY d.account_key, d.customer_key, d.date_key ORDER BY hit.day) AS first
    FROM {days} d,
         LATERAL (SELECT max(o.date_key) AS last FROM {days} o
                  WHERE o.account_key = d.account_key AND (o.date_key, o.customer_key) < (d.date_key, d.customer_key)) before,
         LATERAL (SELECT DISTINCT o.date_key AS day FROM {days} o
                  WHERE o.account_key = d.account_key AND o.date_key >= d.date_key AND o.date_key < d.date_key + {p.r007_window_days}) hit,
         LATERAL (SELECT sum(o.moved) AS moved FROM {days} o
                  WHERE o.account_key = d.account_key AND o.date_key BETWEEN d.date_key AND hit.day) after
    WHERE d.date_key - before.last >= {p.r007_gap_days} AND after.moved >= {p.r007_min_volume}) WHERE first = 1"""
    return _alert_rows(rule, p, found, "max(moved)", "NULL", "max(gap)")


RULES = ("R001", "R002", "R003", "R004", "R005", "R006", "R007", "R008")

cte("evt_alerts", "\nUNION ALL\n".join(rule_sql(r, "evt") for r in RULES), ("evt", "dim_country"))
cte("evt_alerts_default", "\nUNION ALL\n".join(rule_sql(r, "evt", RuleParams()) for r in RULES), ("evt", "dim_country"))
cte("fact_alerts", "\nUNION ALL\n".join(rule_sql(r, "fact") for r in RULES), ("fact", "dim_country"))


def _dim_rule_sql() -> str:
    from ..operators.rules import RULE_CATALOGUE
    rows = ",\n ".join("(" + ", ".join(_sql_text(v) for v in r) + ")" for r in RULE_CATALOGUE)
    return (f"SELECT * FROM (VALUES\n {rows}) AS t(rule_id, rule_name, typology_target, rule_family, "
            "severity, rule_description)")


cte("dim_rule", _dim_rule_sql())

TRAIN_END, VALID_END = S.train_end_day, S.valid_end_day
