"""The same questions in SQL, written independently of the Spark code.

Each statement starts from the raw tables: ``statement`` puts the steps it needs in front.
"""

from __future__ import annotations

from callmeter.schema import DERIVED, FEATURES, MEASURES

_LINES = """
li AS (
  SELECT l_orderkey AS k,
    SUM(CASE WHEN l_partkey % 4 = 0 THEN l_quantity ELSE 0 END) AS day_mins,
    SUM(CASE WHEN l_partkey % 4 = 1 THEN l_quantity ELSE 0 END) AS eve_mins,
    SUM(CASE WHEN l_partkey % 4 = 2 THEN l_quantity ELSE 0 END) AS night_mins,
    CAST(SUM(CASE WHEN l_partkey % 4 = 0 THEN 1 ELSE 0 END) AS INT) AS day_calls,
    CAST(SUM(CASE WHEN l_partkey % 4 = 1 THEN 1 ELSE 0 END) AS INT) AS eve_calls,
    CAST(SUM(CASE WHEN l_partkey % 4 = 2 THEN 1 ELSE 0 END) AS INT) AS night_calls,
    CAST(SUM(CASE WHEN l_partkey % 4 = 3 THEN 1 ELSE 0 END) AS INT) AS intl_calls,
    CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT) AS custserv_calls,
    CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS INT) AS vmail_message
  FROM lineitem GROUP BY l_orderkey)"""
_USAGE = _LINES + """,
usage AS (
  SELECT o.o_orderkey AS account_id,
    CONCAT('555-', CAST(o.o_orderkey AS VARCHAR)) AS phone_number,
    CAST(o.o_custkey % 243 AS INT) AS account_length,
    COALESCE(li.vmail_message, 0) AS vmail_message,
    COALESCE(li.day_mins, 0.0) AS day_mins, COALESCE(li.day_calls, 0) AS day_calls,
    COALESCE(li.day_mins, 0.0) * 0.25 AS day_charge,
    COALESCE(li.eve_mins, 0.0) AS eve_mins, COALESCE(li.eve_calls, 0) AS eve_calls,
    COALESCE(li.eve_mins, 0.0) * 0.125 AS eve_charge,
    COALESCE(li.night_mins, 0.0) AS night_mins, COALESCE(li.night_calls, 0) AS night_calls,
    COALESCE(li.night_mins, 0.0) * 0.0625 AS night_charge,
    COALESCE(CAST(FLOOR(e.value) AS DOUBLE), 0.0) AS intl_mins,
    COALESCE(li.intl_calls, 0) AS intl_calls,
    COALESCE(CAST(FLOOR(e.value) AS DOUBLE), 0.0) * 0.5 AS intl_charge,
    COALESCE(li.custserv_calls, 0) AS custserv_calls,
    (COALESCE(li.custserv_calls, 0) >= 3
      OR (o.o_orderstatus = 'F' AND COALESCE(li.day_mins, 0.0) > 60.0)) AS churn
  FROM orders o LEFT JOIN li ON li.k = o.o_orderkey
  LEFT JOIN events e ON e.event_id = o.o_orderkey)"""


# The same records with nulls where an order has no line items or no event.
_GAPS = _LINES + """,
gaps AS (
  SELECT o.o_orderkey AS account_id, CAST(o.o_custkey % 243 AS INT) AS account_length, li.vmail_message,
    li.day_mins, li.day_calls, li.day_mins * 0.25 AS day_charge,
    li.eve_mins, li.eve_calls, li.eve_mins * 0.125 AS eve_charge,
    li.night_mins, li.night_calls, li.night_mins * 0.0625 AS night_charge,
    CAST(FLOOR(e.value) AS DOUBLE) AS intl_mins, li.intl_calls, CAST(FLOOR(e.value) AS DOUBLE) * 0.5 AS intl_charge,
    li.custserv_calls,
    CAST(COALESCE(li.custserv_calls >= 3, false)
      OR COALESCE(o.o_orderstatus = 'F' AND li.day_mins > 60.0, false) AS INT) AS churn
  FROM orders o LEFT JOIN li ON li.k = o.o_orderkey
  LEFT JOIN events e ON e.event_id = o.o_orderkey)"""


def gaps_statement(body: str, *steps: str) -> str:
    """``body`` on the records with gaps, with further steps before it."""
    return "WITH " + ",".join([_GAPS, *steps]) + "\n" + body


def hash_sql(key: str, digits: int = 8) -> str:
    return f"('0x' || substr(sha256('42|' || {key}), 1, {digits}))::UBIGINT"


def split_sql(bucket: str) -> str:
    return f"CASE WHEN {bucket} < 70 THEN 'train' WHEN {bucket} < 85 THEN 'val' ELSE 'test' END"


def fingerprint_sql(columns: list[str]) -> str:
    texts = (f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
    return f"sha256(concat_ws('||', {', '.join(texts)}))"


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN {top} / {bottom} ELSE 0.0 END"


def features_sql(source: str, ratio=_ratio) -> str:
    return f"""
  SELECT s.*,
    {ratio('intl_charge', 'total_charge')} AS intl_charge_ratio,
    {ratio('total_mins', 'total_calls')} AS avg_call_duration,
    {ratio('custserv_calls', 'account_length')} AS custserv_rate,
    {ratio('night_mins', 'day_mins')} AS night_day_ratio,
    {ratio('total_charge', 'total_mins')} AS charge_per_min
  FROM (SELECT *,
      day_mins + eve_mins + night_mins + intl_mins AS total_mins,
      day_calls + eve_calls + night_calls + intl_calls AS total_calls,
      day_charge + eve_charge + night_charge + intl_charge AS total_charge
    FROM {source}) s"""


def score_sql(calls: str, minutes: str, offset: str) -> str:
    logit = (
        f"CAST({calls} AS DOUBLE) * custserv_calls + CAST({minutes} AS DOUBLE) * day_mins"
        f" - CAST({offset} AS DOUBLE)"
    )
    return f"round(1.0 / (1.0 + exp(-({logit}))), 6)"


def as_spark_rounds(value: str, digits: int) -> str:
    """Round the shortest decimal text of a double, halves away from zero."""
    return (
        f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"
    )


_STATS = ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in MEASURES
)
_EXTREME = {
    c: f"coalesce(abs((b.{c} - st.m_{c}) / nullif(st.s_{c}, 0)) > 6, false)" for c in MEASURES
}

STEPS = {
    "usage": _USAGE,
    "base": f"""
base AS (
  SELECT account_id, {', '.join(MEASURES)}, CAST(churn AS INT) AS churn FROM usage)""",
    "flagged": f"""
st AS (SELECT {_STATS} FROM base),
flagged AS (
  SELECT b.*, {', '.join(f'{e} AS {c}_flag' for c, e in _EXTREME.items())}
  FROM base b CROSS JOIN st)""",
    "status": f"""
status AS (
  SELECT account_id, {', '.join(MEASURES)}, churn,
    CASE WHEN {' OR '.join(f'{c}_flag' for c in MEASURES)} THEN 'anomaly' ELSE 'clean' END AS status
  FROM flagged)""",
    "clean": f"""
clean AS (
  SELECT account_id, {', '.join(MEASURES)}, churn FROM status WHERE status = 'clean')""",
    "prepared": f"""
prepared AS (
  SELECT f.*, {split_sql(hash_sql('account_id') + ' % 100')} AS split
  FROM ({features_sql('clean')}) f)""",
    "scored": f"""
scored AS (
  SELECT account_id, churn, split, {score_sql('0.9', '0.03', '3.0')} AS score,
    {score_sql('0.6', '0.05', '3.5')} AS score_b
  FROM prepared)""",
}
_ORDER = list(STEPS)


def statement(step: str, body: str) -> str:
    """``body`` with all steps up to ``step`` in front of it."""
    needed = _ORDER[: _ORDER.index(step) + 1]
    return "WITH " + ",".join(STEPS[s] for s in needed) + "\n" + body


def per_column(source: str, columns: list[str], figures: str) -> str:
    """``figures`` (with ``{c}`` for the column) once per column, as rows."""
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", {figures.format(c=c)} FROM {source}" for c in columns
    )


def long_form(source: str, columns: list[str], keep: str = "") -> str:
    keep = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS col, CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns
    )


DERIVED_LIST = ", ".join(DERIVED)
FEATURE_LIST = ", ".join(FEATURES)
MEASURE_LIST = ", ".join(MEASURES)
