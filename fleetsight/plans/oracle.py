"""Independent SQL (DuckDB dialect) for the fixtures and the cleaning / feature stages.

The registry composes these CTEs into one statement per query. Written from the semantics in
the operator docstrings, not generated from the Spark plans, so the two can disagree.
"""

from __future__ import annotations

from fleetsight.spec import DEFAULT_SPEC, TelemetrySpec

C1_TELEMETRY = """
telemetry AS (
  SELECT
    CAST(l_shipdate AS DATE) AS date,
    concat('S', CAST(l_suppkey AS VARCHAR)) AS serial_number,
    concat(' ', lower(n_name), ' ') AS model,
    CAST(floor(s_acctbal) AS BIGINT) * 1000000000 AS capacity_bytes,
    CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity >= 49
              AND l_discount >= 0.09 AND l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS failure,
    CAST(l_linenumber - 1 AS BIGINT) AS smart_5_raw,
    CAST(l_orderkey % 50000 AS BIGINT) AS smart_9_raw,
    CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS smart_187_raw,
    CAST(CASE WHEN l_partkey % 40 = 0 THEN 1 + l_partkey % 7 ELSE 0 END AS BIGINT) AS smart_188_raw,
    CAST(20 + CAST(l_quantity AS BIGINT) % 30 AS BIGINT) AS smart_194_raw,
    CASE WHEN l_linenumber >= 6 THEN CAST(l_linenumber AS BIGINT) ELSE 0 END AS smart_197_raw,
    CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE CAST(l_partkey % 3 AS BIGINT) END AS smart_198_raw,
    CAST(NULL AS BIGINT) AS smart_5_normalized,
    CAST(NULL AS BIGINT) AS smart_9_normalized,
    CAST(NULL AS BIGINT) AS smart_187_normalized,
    CAST(NULL AS BIGINT) AS smart_188_normalized,
    CAST(NULL AS BIGINT) AS smart_194_normalized,
    CAST(NULL AS BIGINT) AS smart_197_normalized,
    CAST(NULL AS BIGINT) AS smart_198_normalized
  FROM lineitem
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
)"""

C4_EVENTS = """
telemetry AS (
  SELECT CAST(ts AS DATE) AS date,
         concat('U', CAST(user_id AS VARCHAR)) AS serial_number,
         concat('M', CAST(user_id % 5 AS VARCHAR)) AS model,
         0 AS failure,
         value
  FROM events
)"""

C2_SCORED = """
scored AS (
  SELECT l.doc_id AS entity, l.doc_id % 200 AS entity_group,
         CAST(l.quality AS DOUBLE) AS failure_label,
         CAST(least(d.n_chars / 5000.0, 1.0) AS DOUBLE) AS failure_probability
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
)"""

C6_STREAM = """
scores AS (
  SELECT CAST(floor(event_id / 1000) AS BIGINT) AS batch_id,
         ts AS scored_at,
         CAST(ts AS DATE) AS date,
         concat('U', CAST(user_id AS VARCHAR)) AS serial_number,
         concat('M', CAST(user_id % 5 AS VARCHAR)) AS model,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS anomalous_counter_count,
         value / 50.0 AS max_error_zscore,
         least(value / 500.0, 1.0) AS failure_probability
  FROM events
)"""


def _cols(names) -> str:
    return ", ".join(names)


def clean_ctes(spec: TelemetrySpec = DEFAULT_SPEC, zscores: bool = True, source: str = "telemetry") -> str:
    """CTEs valid -> dedup [-> stats -> cleaned]; the last one is always called ``cleaned``."""
    conds = [f"{c} IS NOT NULL" for c in (spec.date, spec.entity, spec.group, spec.event)]
    if spec.capacity:
        conds.append(f"{spec.capacity} > 0")
    conds.append(f"{spec.event} IN (0, 1)")
    first = [spec.event] + ([spec.capacity] if spec.capacity else []) + spec.raw_columns
    rest = [spec.group] + spec.normalized_columns
    order = ", ".join(f"{c} DESC NULLS LAST" for c in first + rest)
    out = f"""
normalized AS (SELECT * REPLACE (upper(trim({spec.group})) AS {spec.group}) FROM {source}),
valid AS (SELECT * FROM normalized WHERE {' AND '.join(conds)}),
dedup AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {spec.entity}, {spec.date} ORDER BY {order}) AS _rn FROM valid
  ) WHERE _rn = 1
)"""
    if not zscores:
        return out + f",\ncleaned AS (SELECT * FROM dedup)"
    stats = ", ".join(
        [f"avg({c}) AS {c}_m" for c in spec.raw_columns] + [f"stddev_samp({c}) AS {c}_s" for c in spec.raw_columns]
    )
    zs = ", ".join(
        f"CASE WHEN d.{m.raw} IS NULL THEN NULL WHEN s.{m.raw}_s > 0 THEN (d.{m.raw} - s.{m.raw}_m) / s.{m.raw}_s "
        f"ELSE 0.0 END AS {m.zscore}"
        for m in spec.metrics
    )
    rep = ", ".join(f"d.{m.raw} IS NOT NULL AS {m.reported}" for m in spec.metrics)
    return out + f""",
stats AS (SELECT {spec.group}, {stats} FROM dedup GROUP BY {spec.group}),
cleaned AS (
  SELECT d.*, {zs}, {rep}
  FROM dedup d LEFT JOIN stats s ON s.{spec.group} = d.{spec.group}
)"""


def feature_ctes(spec: TelemetrySpec = DEFAULT_SPEC, source: str = "cleaned", frame: str = "rows") -> str:
    """CTE ``features`` over ``source``: age, trends, failure date, days until it, label."""
    part = f"PARTITION BY {spec.group}, {spec.entity}"
    trends = []
    for m in spec.metrics:
        for n in spec.trend_rows:
            if frame == "rows":
                w = f"({part} ORDER BY {spec.date} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
            else:
                w = f"({part} ORDER BY {spec.date} RANGE BETWEEN INTERVAL {n} DAYS PRECEDING AND CURRENT ROW)"
            trends.append(f"avg({m.raw}) OVER {w} AS {m.trend(n)}")
    return f"""
aged AS (
  SELECT *, min({spec.date}) OVER ({part}) AS first_seen,
         max(CASE WHEN {spec.event} = 1 THEN {spec.date} END) OVER ({part}) AS failure_date,
         {', '.join(trends)}
  FROM {source}
),
features AS (
  SELECT * EXCLUDE (failure_date, {', '.join(spec.trend_columns)}),
         CAST(date_diff('day', first_seen, {spec.date}) AS INTEGER) AS age_days,
         {', '.join(spec.trend_columns)},
         failure_date,
         CAST(date_diff('day', {spec.date}, failure_date) AS INTEGER) AS days_until_failure,
         CASE WHEN date_diff('day', {spec.date}, failure_date) BETWEEN 0 AND {spec.horizon_days}
              THEN 1 ELSE 0 END AS {spec.label}
  FROM aged
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes if c.strip())


def rounded(inner: str, double_cols: list[str], digits: int = 6) -> str:
    """Wrap a query so the given double columns are rounded like the Spark side."""
    if not double_cols:
        return inner
    repl = ", ".join(f"round({c}, {digits}) AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{inner}\n) AS _q"
