"""DuckDB SQL for every oracle-checked query (tables pre-registered as views).

Written independently of the Spark code, in DuckDB's own dialect.  Types are
cast to what Spark produces (INTEGER for date parts, BIGINT for sums and
counts), and the floating columns the Spark query rounds are rounded here too.
"""

from __future__ import annotations

LAGS = [1, 2, 3, 6, 12, 24]
WINDOWS = [3, 6, 12, 24, 48]
STATS = ["avg", "std", "min", "max"]
T = "demand_15min_total"
SER = "PARTITION BY item_id, store_id ORDER BY timestamp_15min ASC NULLS FIRST"

STORE_OF_USER = "CASE user_id % 3 WHEN 0 THEN 'CA_1' WHEN 1 THEN 'TX_1' ELSE 'WI_1' END"
CAT_OF_EVENT = ("CASE WHEN event_type IN ('view', 'click') THEN 'FOODS' "
                "WHEN event_type = 'purchase' THEN 'HOUSEHOLD' ELSE 'HOBBIES' END")

DEMAND_5MIN = f"""
demand_5min AS (
  SELECT event_type AS item_id,
         {STORE_OF_USER} AS store_id,
         split_part({STORE_OF_USER}, '_', 1) AS state_id,
         {CAT_OF_EVENT} AS cat_id,
         {CAT_OF_EVENT} || CASE WHEN event_type IN ('click', 'error') THEN '_2' ELSE '_1' END AS dept_id,
         ts AS "timestamp",
         CAST(ts AS DATE) AS date,
         CAST(hour(ts) AS INTEGER) AS hour,
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
         CAST(month(ts) AS INTEGER) AS month,
         CAST(year(ts) AS INTEGER) AS year,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS demand_5min,
         CAST(hour(ts) * 12 + floor(minute(ts) / 5) AS INTEGER) AS interval_5min
  FROM events
)"""

GROUP_HEAD = "item_id, store_id, state_id, cat_id, dept_id, date"
GROUP_TAIL = "hour, day_of_week, month, year"

AGG15 = f"""
agg15 AS (
  SELECT {GROUP_HEAD}, time_bucket(INTERVAL 15 MINUTE, "timestamp") AS timestamp_15min, {GROUP_TAIL},
         CAST(sum(demand_5min) AS BIGINT) AS demand_15min_total,
         avg(demand_5min) AS demand_15min_avg,
         count(demand_5min) AS demand_15min_count,
         stddev_samp(demand_5min) AS demand_15min_std,
         min(demand_5min) AS demand_15min_min,
         max(demand_5min) AS demand_15min_max
  FROM demand_5min
  GROUP BY ALL
)"""

AGG5 = f"""
agg5 AS (
  SELECT {GROUP_HEAD}, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS timestamp_5min, {GROUP_TAIL},
         CAST(sum(demand_5min) AS BIGINT) AS demand_5min_total,
         avg(demand_5min) AS demand_5min_avg,
         count(demand_5min) AS demand_5min_count,
         stddev_samp(demand_5min) AS demand_5min_std
  FROM demand_5min
  GROUP BY ALL
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


AGG15_COLS = [
    "item_id", "store_id", "state_id", "cat_id", "dept_id", "date", "timestamp_15min", "hour", "day_of_week",
    "month", "year", "demand_15min_total", "demand_15min_avg", "demand_15min_count", "demand_15min_std",
    "demand_15min_min", "demand_15min_max",
]
AGG15_DOUBLES = {"demand_15min_avg", "demand_15min_std"}


def lag_sql(k: int) -> str:
    return f"lag({T}, {k}) OVER ({SER}) AS {T}_lag_{k}"


def rolling_sql(stat: str, n: int) -> str:
    frame = f"({SER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    fn = {"avg": f"avg(CAST({T} AS DOUBLE))", "std": f"stddev_samp(CAST({T} AS DOUBLE))",
          "min": f"min({T})", "max": f"max({T})"}[stat]
    return f"{fn} OVER {frame} AS {T}_rolling_{stat}_{n}"


def lead_sql(h: int) -> str:
    return f"lead({T}, {h}) OVER ({SER}) AS target_{T}_next_{h}"


LAG_NAMES = [f"{T}_lag_{k}" for k in LAGS]
ROLL_NAMES = [f"{T}_rolling_{s}_{n}" for n in WINDOWS for s in STATS]
ROLL_DOUBLES = {f"{T}_rolling_{s}_{n}" for n in WINDOWS for s in ("avg", "std")}

CAL_SQL = {
    "hour_of_day": "CAST(hour(timestamp_15min) AS INTEGER)",
    "day_of_month": "CAST(day(timestamp_15min) AS INTEGER)",
    "day_of_year": "CAST(dayofyear(timestamp_15min) AS INTEGER)",
    "week_of_year": "CAST(week(timestamp_15min) AS INTEGER)",
    "quarter": "CAST(quarter(timestamp_15min) AS INTEGER)",
    "is_weekend": "CASE WHEN day_of_week IN (5, 6) THEN 1 ELSE 0 END",
    "is_month_start": "CASE WHEN day(timestamp_15min) <= 3 THEN 1 ELSE 0 END",
    "is_month_end": "CASE WHEN day(timestamp_15min) >= 28 THEN 1 ELSE 0 END",
    "is_quarter_start": "CASE WHEN month IN (1, 4, 7, 10) AND day(timestamp_15min) <= 7 THEN 1 ELSE 0 END",
    "is_quarter_end": "CASE WHEN month IN (3, 6, 9, 12) AND day(timestamp_15min) >= 24 THEN 1 ELSE 0 END",
}

FEATS = f"""
feats AS (
  SELECT *,
         {", ".join(lag_sql(k) for k in LAGS)},
         {", ".join(rolling_sql(s, n) for n in WINDOWS for s in STATS)},
         timestamp_15min AS timestamp_dt,
         {", ".join(f"{v} AS {k}" for k, v in CAL_SQL.items())},
         {lead_sql(1)}
  FROM agg15
)"""

FEATURE_TABLE_COLS = AGG15_COLS + LAG_NAMES + ROLL_NAMES + ["timestamp_dt"] + list(CAL_SQL) + [f"target_{T}_next_1"]
FEATURE_DOUBLES = AGG15_DOUBLES | ROLL_DOUBLES
EXCLUDED = ["timestamp", "date", "target_", "item_id", "store_id"]
ML_FEATURES = [c for c in FEATURE_TABLE_COLS if not any(x in c.lower() for x in EXCLUDED)]
ML_STRINGS = {"state_id", "cat_id", "dept_id"}


def _ml_select() -> str:
    parts = ["item_id", "store_id", "timestamp_15min"]
    for c in ML_FEATURES:
        if c in ML_STRINGS:
            parts.append(c)
        elif c in FEATURE_DOUBLES:
            parts.append(r6(f"coalesce({c}, 0)", c))
        else:
            parts.append(f"coalesce({c}, 0) AS {c}")
    parts.append(f"target_{T}_next_1")
    return ", ".join(parts)


ML = f"""
ml AS (
  SELECT {_ml_select()}
  FROM feats
  WHERE target_{T}_next_1 IS NOT NULL
)"""


def _select_rounded(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(r6(c, c) if c in doubles else c for c in cols)


# ---------------------------------------------------------------- calendar and feeds
def _on(m: int, d: int) -> str:
    return f"(month(dt) = {m} AND day(dt) = {d})"


CALENDAR = f"""
cal_days AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt FROM orders
),
calendar AS (
  SELECT CAST(dt AS VARCHAR) AS date,
         CAST(year(dt) * 100 + week(dt) AS INTEGER) AS wm_yr_wk,
         dayname(dt) AS weekday,
         CAST((dayofweek(dt) + 1) % 7 + 1 AS INTEGER) AS wday,
         CAST(month(dt) AS INTEGER) AS month,
         CAST(year(dt) AS INTEGER) AS year,
         'd_' || CAST(row_number() OVER (ORDER BY dt ASC NULLS FIRST) AS VARCHAR) AS d,
         CASE WHEN {_on(12, 25)} THEN 'Christmas' WHEN {_on(1, 1)} THEN 'NewYear'
              WHEN {_on(7, 4)} THEN 'IndependenceDay' WHEN {_on(9, 1)} THEN 'LaborDay' END AS event_name_1,
         CASE WHEN {_on(12, 25)} THEN 'Religious' WHEN {_on(1, 1)} THEN 'National'
              WHEN {_on(7, 4)} THEN 'National' WHEN {_on(9, 1)} THEN 'National' END AS event_type_1,
         CASE WHEN {_on(12, 31)} THEN 'NewYearsEve'
              WHEN {_on(12, 25)} AND year(dt) % 2 = 0 THEN 'OrthodoxChristmas' END AS event_name_2,
         CASE WHEN {_on(12, 31)} THEN 'Cultural'
              WHEN {_on(12, 25)} AND year(dt) % 2 = 0 THEN 'Religious' END AS event_type_2,
         CAST(day(dt) <= 10 AS INTEGER) AS snap_CA,
         CAST(day(dt) IN (1, 3, 5, 6, 7, 9, 11, 12, 13, 15) AS INTEGER) AS snap_TX,
         CAST(day(dt) IN (2, 3, 5, 6, 8, 9, 11, 12, 14, 15) AS INTEGER) AS snap_WI
  FROM cal_days
)"""

CAL = with_(CALENDAR)

STORE_OF_SUPP = "CASE l_suppkey % 3 WHEN 0 THEN 'CA_1' WHEN 1 THEN 'TX_1' ELSE 'WI_1' END"
ITEM_OF_PART = "'ITEM_' || lpad(CAST(l_partkey % 500 AS VARCHAR), 4, '0')"
CAT_OF_PART = "CASE l_partkey % 500 % 3 WHEN 0 THEN 'FOODS' WHEN 1 THEN 'HOUSEHOLD' ELSE 'HOBBIES' END"
DAYS = [f"d_{i}" for i in range(1, 13)]

SALES_WIDE = f"""
sales_wide AS (
  SELECT {ITEM_OF_PART} AS item_id,
         {CAT_OF_PART} || '_1' AS dept_id,
         {CAT_OF_PART} AS cat_id,
         {STORE_OF_SUPP} AS store_id,
         split_part({STORE_OF_SUPP}, '_', 1) AS state_id,
         {", ".join(f"CAST(sum(CASE WHEN month(l_shipdate) = {i} THEN l_quantity END) AS INTEGER) AS d_{i}" for i in range(1, 13))}
  FROM lineitem
  GROUP BY ALL
)"""

PRICES = f"""
prices AS (
  SELECT {STORE_OF_SUPP} AS store_id,
         {ITEM_OF_PART} AS item_id,
         CAST(year(l_shipdate) * 100 + week(l_shipdate) AS INTEGER) AS wm_yr_wk,
         min(CASE WHEN l_discount > 0 THEN l_extendedprice / l_quantity END) AS sell_price
  FROM lineitem
  GROUP BY ALL
)"""

CALENDAR_FEED = f"""{CAL}
SELECT TRY_CAST(date AS DATE) AS date, wm_yr_wk, weekday, wday, month, year, d,
       event_name_1, event_type_1, event_name_2, event_type_2,
       CAST(snap_CA AS BOOLEAN) AS snap_CA, CAST(snap_TX AS BOOLEAN) AS snap_TX, CAST(snap_WI AS BOOLEAN) AS snap_WI,
       CAST(dayofweek(TRY_CAST(date AS DATE)) + 1 AS INTEGER) AS day_of_week,
       CAST(dayofyear(TRY_CAST(date AS DATE)) AS INTEGER) AS day_of_year,
       CAST(quarter(TRY_CAST(date AS DATE)) AS INTEGER) AS quarter,
       coalesce(wday IN (1, 2), false) AS is_weekend,
       (event_name_1 IS NOT NULL OR event_name_2 IS NOT NULL) AS has_event,
       'calendar' AS data_source
FROM calendar"""

SALES_FEED = f"""{with_(SALES_WIDE)}
SELECT item_id, dept_id, cat_id, store_id, state_id, day, CAST(sales_quantity AS INTEGER) AS sales_quantity,
       'sales' AS data_source
FROM sales_wide UNPIVOT INCLUDE NULLS (sales_quantity FOR day IN ({", ".join(DAYS)}))"""

PRICES_FEED = f"""{with_(PRICES)}
SELECT store_id, item_id, wm_yr_wk, sell_price, sell_price IS NULL AS price_missing, 'prices' AS data_source
FROM prices"""

SOURCE_MONITOR = f"""{with_(CALENDAR, SALES_WIDE, PRICES)}
SELECT 'calendar' AS data_source, count(*) AS record_count FROM calendar
UNION ALL SELECT 'prices', count(*) FROM prices
UNION ALL SELECT 'sales', count(*) * {len(DAYS)} FROM sales_wide"""

# ---------------------------------------------------------------- calendar profile
CAL_COLS = ["date", "wm_yr_wk", "weekday", "wday", "month", "year", "d", "event_name_1", "event_type_1",
            "event_name_2", "event_type_2", "snap_CA", "snap_TX", "snap_WI"]
NUMERIC_CAL = ["wm_yr_wk", "wday", "month", "year", "snap_CA", "snap_TX", "snap_WI"]
CALD = CAL + ", cald AS (SELECT * REPLACE (TRY_CAST(date AS DATE) AS date) FROM calendar)\n"
HAS_EVENT = "(event_name_1 IS NOT NULL OR event_name_2 IS NOT NULL)"


def _unpivot_one_row(select_list: str, names: list[str], name_col: str, value_col: str, src: str) -> str:
    return (f"SELECT * FROM (SELECT {select_list} FROM {src}) "
            f"UNPIVOT INCLUDE NULLS ({value_col} FOR {name_col} IN ({', '.join(names)}))")


def _describe() -> str:
    parts = []
    for c in NUMERIC_CAL:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({x}) AS DOUBLE) AS count, {r6(f'avg({x})', 'mean')}, "
            f"{r6(f'stddev_samp({x})', 'std')}, min({x}) AS min, {r6(f'quantile_cont({x}, 0.25)', 'q25')}, "
            f"{r6(f'quantile_cont({x}, 0.5)', 'q50')}, {r6(f'quantile_cont({x}, 0.75)', 'q75')}, max({x}) AS max "
            f"FROM calendar"
        )
    return CAL + "\n" + "\nUNION ALL ".join(parts)


CORR_COLS = ["month", "quarter", "wday", "is_weekend", "snap_CA", "snap_TX", "snap_WI"]
ENH = CALD + """, enh AS (
  SELECT *, CAST(quarter(date) AS INTEGER) AS quarter, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
         CAST(week(date) AS INTEGER) AS week_of_year,
         CASE WHEN wday IN (1, 2) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS is_month_end,
         CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS is_month_start
  FROM cald)
"""


def _corr() -> str:
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            den = f"stddev_samp({a}) * stddev_samp({b})"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}) / NULLIF({den}, 0), 6) AS r FROM enh")
    return ENH + "\nUNION ALL ".join(parts)


def _quality() -> str:
    metrics = {
        "total_rows": "count(*)",
        "first_date": "datediff('day', DATE '1970-01-01', min(date))",
        "last_date": "datediff('day', DATE '1970-01-01', max(date))",
        "duplicate_dates": "count(*) - count(DISTINCT date) - CASE WHEN count(*) > count(date) THEN 1 ELSE 0 END",
        "weekend_days": "count(*) FILTER (WHERE wday IN (1, 2))",
        "weekday_days": "count(*) FILTER (WHERE NOT (wday IN (1, 2)))",
        "event_coverage": "count(event_name_1) + count(event_name_2)",
    }
    metrics |= {f"missing_{c}": f"count(*) FILTER (WHERE {c} IS NULL)" for c in CAL_COLS}
    sel = ", ".join(f"CAST({v} AS BIGINT) AS {k}" for k, v in metrics.items())
    return CALD + _unpivot_one_row(sel, list(metrics), "metric", "value", "cald")


def _nulls() -> str:
    sel = ", ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}" for c in CAL_COLS)
    return CAL + "\n" + _unpivot_one_row(sel, CAL_COLS, '"column"', "nulls", "calendar")


def _freq(col: str) -> str:
    return f"{CAL}\nSELECT {col}, count(*) AS count FROM calendar WHERE {col} IS NOT NULL GROUP BY {col}"


def _snap_by(col: str) -> str:
    sums = ", ".join(f"CAST(sum({s}) AS BIGINT) AS {s}" for s in ("snap_CA", "snap_TX", "snap_WI"))
    return f"{CAL}\nSELECT {col}, {sums} FROM calendar WHERE {col} IS NOT NULL GROUP BY {col}"


HOLIDAYS = ["Christmas", "Thanksgiving", "NewYear", "Independence", "LaborDay"]

PROFILE_SQL = {
    "table_shape": CAL + f"\nSELECT count(*) AS rows, {len(CAL_COLS)} AS columns FROM calendar",
    "date_span": CALD + "SELECT min(date) AS min_date, max(date) AS max_date, "
    "CAST(datediff('day', min(date), max(date)) AS INTEGER) AS total_days FROM cald",
    "missing_dates": CALD + ", span AS (SELECT min(date) AS lo, max(date) AS hi FROM cald WHERE date IS NOT NULL)\n"
    "SELECT CAST(g AS DATE) AS date FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), "
    "INTERVAL 1 DAY)) AS g FROM span) WHERE CAST(g AS DATE) NOT IN (SELECT date FROM cald WHERE date IS NOT NULL)",
    "duplicate_dates": CALD + "SELECT count(*) - count(DISTINCT date) - CASE WHEN count(*) > count(date) THEN 1 ELSE 0 END "
    "AS duplicate_dates FROM cald",
    "null_counts": _nulls(),
    "describe_numeric": _describe(),
    "quality_report": _quality(),
    "insight_summary": CALD + _unpivot_one_row(
        "CAST(datediff('day', min(date), max(date)) AS BIGINT) AS days_covered, "
        "CAST(count(event_name_1) AS BIGINT) AS events_identified",
        ["days_covered", "events_identified"], "topic", "value", "cald"),
    "freq_weekday": _freq("weekday"),
    "freq_month": _freq("month"),
    "freq_year": _freq("year"),
    "freq_wday": _freq("wday"),
    "snap_totals": CAL + "\nSELECT " + ", ".join(f"CAST(sum({s}) AS BIGINT) AS {s}" for s in ("snap_CA", "snap_TX", "snap_WI"))
    + " FROM calendar",
    "snap_by_month": _snap_by("month"),
    "snap_by_wday": _snap_by("wday"),
    "event_share": CAL + f"\nSELECT count(*) FILTER (WHERE {HAS_EVENT}) AS event_days, count(*) AS total_days, "
    f"round(CAST(count(*) FILTER (WHERE {HAS_EVENT}) AS DOUBLE) * 100 / count(*), 2) AS event_pct FROM calendar",
    "event_types": CAL + "\nSELECT event_type, count(*) AS count FROM ("
    "SELECT event_type_1 AS event_type FROM calendar UNION ALL SELECT event_type_2 FROM calendar) "
    "WHERE event_type IS NOT NULL GROUP BY event_type",
    "events_by_month": CAL + f"\nSELECT year, month, count(*) AS events FROM calendar WHERE {HAS_EVENT} "
    "AND year IS NOT NULL AND month IS NOT NULL GROUP BY year, month",
    "month_wday_crosstab": CAL + "\nSELECT month, " + ", ".join(
        f"CAST(count(*) FILTER (WHERE wday = {w}) AS BIGINT) AS wday_{w}" for w in range(1, 8))
    + " FROM calendar WHERE month IS NOT NULL AND wday IS NOT NULL GROUP BY month",
    "holiday_impact": CAL + ", hol(holiday) AS (VALUES " + ", ".join(f"('{h}')" for h in HOLIDAYS) + ")\n"
    "SELECT holiday, count(*) AS count, array_to_string(list_sort(list_distinct(list(month))), ',') AS months, "
    "array_to_string(list_sort(list_distinct(list(year))), ',') AS years "
    "FROM calendar JOIN hol ON coalesce(regexp_matches(event_name_1, holiday), false) "
    "OR coalesce(regexp_matches(event_name_2, holiday), false) GROUP BY holiday",
    "feature_correlations": _corr(),
    "exact_month_edges": ENH + "SELECT date, quarter, day_of_year, week_of_year, is_weekend, is_month_start, "
    "is_month_end FROM enh",
    "head_rows": CAL + "\nSELECT * FROM calendar ORDER BY date ASC NULLS FIRST LIMIT 5",
}

# ---------------------------------------------------------------- demand queries
KEYS = "item_id, store_id, timestamp_15min"
BASE = with_(DEMAND_5MIN, AGG15)
AGG5_COLS = [
    "item_id", "store_id", "state_id", "cat_id", "dept_id", "date", "timestamp_5min", "hour", "day_of_week",
    "month", "year", "demand_5min_total", "demand_5min_avg", "demand_5min_count", "demand_5min_std",
]


SER5 = "PARTITION BY item_id, store_id ORDER BY timestamp_5min ASC NULLS FIRST"
T5 = "demand_5min_total"


def _roll5(stat: str, n: int) -> str:
    frame = f"({SER5} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    fn = {"avg": f"avg(CAST({T5} AS DOUBLE))", "std": f"stddev_samp(CAST({T5} AS DOUBLE))",
          "min": f"min({T5})", "max": f"max({T5})"}[stat]
    expr = f"{fn} OVER {frame}"
    return r6(expr, f"{T5}_rolling_{stat}_{n}") if stat in ("avg", "std") else f"{expr} AS {T5}_rolling_{stat}_{n}"


def _rolling_query(stat: str) -> str:
    cols = [rolling_sql(stat, n) for n in WINDOWS]
    names = [f"{T}_rolling_{stat}_{n}" for n in WINDOWS]
    inner = f"SELECT {KEYS}, {T}, {', '.join(cols)} FROM agg15"
    outer = ", ".join(r6(n, n) if stat in ("avg", "std") else n for n in names)
    return f"{BASE}\nSELECT {KEYS}, {T}, {outer} FROM ({inner})"


def _span_query() -> str:
    """Rolling statistics over the last hours by RANGE frames."""
    spans = {"1_hour": 1, "3_hours": 3, "12_hours": 12}
    fns = {"avg": f"avg(CAST({T} AS DOUBLE))", "std": f"stddev_samp(CAST({T} AS DOUBLE))", "min": f"min({T})", "max": f"max({T})"}
    frame = "PARTITION BY item_id, store_id ORDER BY timestamp_15min RANGE BETWEEN INTERVAL '{} microseconds' PRECEDING AND CURRENT ROW"
    cols = [f"{fns[s]} OVER ({frame.format(h * 3_600_000_000 - 1)}) AS {T}_last_{w}_{s}" for w, h in spans.items() for s in STATS]
    outer = ", ".join(r6(n, n) if s in ("avg", "std") else n for w in spans for s in STATS for n in [f"{T}_last_{w}_{s}"])
    return f"{BASE}\nSELECT {KEYS}, {T}, {outer} FROM (SELECT {KEYS}, {T}, {', '.join(cols)} FROM agg15)"


PERSIST = BASE + f""",
persist AS (
  SELECT item_id, store_id, timestamp_15min AS "timestamp", CAST({T} AS DOUBLE) AS actual_demand,
         CAST(lag({T}, 1) OVER ({SER}) AS DOUBLE) AS predicted_demand
  FROM agg15
),
results AS (
  SELECT item_id, store_id, "timestamp", actual_demand, predicted_demand,
         actual_demand - predicted_demand AS prediction_error,
         abs(actual_demand - predicted_demand) AS absolute_error
  FROM persist WHERE predicted_demand IS NOT NULL
)
"""

CAT_INDEX = BASE + "".join(
    f""",
{c}_lab AS (
  SELECT {c} AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS idx
  FROM agg15 WHERE {c} IS NOT NULL GROUP BY {c}
)"""
    for c in ("state_id", "cat_id", "dept_id")
) + "\nSELECT a.item_id, a.store_id, a.timestamp_15min, a.state_id, a.cat_id, a.dept_id, " + ", ".join(
    f"coalesce({c}_lab.idx, (SELECT CAST(count(*) AS DOUBLE) FROM {c}_lab)) AS {c}_idx"
    for c in ("state_id", "cat_id", "dept_id")
) + " FROM agg15 a " + " ".join(
    f"LEFT JOIN {c}_lab ON a.{c} = {c}_lab.label" for c in ("state_id", "cat_id", "dept_id")
)

DEMAND_SQL = {
    "agg_5min": with_(DEMAND_5MIN, AGG5) + f"\nSELECT {_select_rounded(AGG5_COLS, {'demand_5min_avg', 'demand_5min_std'})} FROM agg5",
    "agg_15min": BASE + f"\nSELECT {_select_rounded(AGG15_COLS, AGG15_DOUBLES)} FROM agg15",
    "agg_30min": with_(DEMAND_5MIN) + """
SELECT item_id, store_id, time_bucket(INTERVAL 30 MINUTE, "timestamp") AS window_start,
       time_bucket(INTERVAL 30 MINUTE, "timestamp") + INTERVAL 30 MINUTE AS window_end,
       CAST(sum(demand_5min) AS BIGINT) AS demand_30min
FROM demand_5min GROUP BY ALL""",
    "lag_features": f"{BASE}\nSELECT {KEYS}, {T}, {', '.join(lag_sql(k) for k in LAGS)} FROM agg15",
    "agg_60min": with_(DEMAND_5MIN) + """
SELECT item_id, store_id, time_bucket(INTERVAL 60 MINUTE, "timestamp") AS window_start,
       time_bucket(INTERVAL 60 MINUTE, "timestamp") + INTERVAL 60 MINUTE AS window_end,
       CAST(sum(demand_5min) AS BIGINT) AS demand_60min
FROM demand_5min GROUP BY ALL""",
    "lag_features_5min": with_(DEMAND_5MIN, AGG5) + f"\nSELECT item_id, store_id, timestamp_5min, {T5}, "
    + ", ".join(f"lag({T5}, {k}) OVER ({SER5}) AS {T5}_lag_{k}" for k in (1, 2, 3)) + " FROM agg5",
    "rolling_features_5min": with_(DEMAND_5MIN, AGG5) + f"\nSELECT item_id, store_id, timestamp_5min, {T5}, "
    + ", ".join(_roll5(s_, n) for n in (3, 12) for s_ in STATS) + " FROM agg5",
    "rolling_avg": _rolling_query("avg"),
    "rolling_std": _rolling_query("std"),
    "rolling_min": _rolling_query("min"),
    "rolling_max": _rolling_query("max"),
    "target_lead": f"{BASE}\nSELECT {KEYS}, {T}, {lead_sql(1)} FROM agg15",
    "target_multi_horizon": f"{BASE}\nSELECT {KEYS}, {T}, {', '.join(lead_sql(h) for h in (1, 2, 4))} FROM agg15",
    "calendar_features": f"{BASE}\nSELECT {KEYS}, day_of_week, month, "
    + ", ".join(f"{v} AS {k}" for k, v in CAL_SQL.items()) + " FROM agg15",
    "business_hours": f"{BASE}\nSELECT {KEYS}, hour, CASE WHEN hour BETWEEN 9 AND 17 THEN 1 ELSE 0 END "
    "AS is_business_hours FROM agg15",
    "demand_features": f"{BASE},{FEATS}\nSELECT {_select_rounded(FEATURE_TABLE_COLS, FEATURE_DOUBLES)} FROM feats",
    "ml_features": f"{BASE},{FEATS},{ML}\nSELECT * FROM ml",
    "demand_features_chunked": f"{BASE},{FEATS}\nSELECT {_select_rounded(FEATURE_TABLE_COLS, FEATURE_DOUBLES)} FROM feats",
    "state_one_hot": f"{BASE}\nSELECT {KEYS}, "
    + ", ".join(f"CASE WHEN split_part(store_id, '_', 1) = '{s}' THEN 1 ELSE 0 END AS state_id_{s}"
                for s in ("CA", "TX", "WI")) + " FROM agg15",
    "single_observation_aggregates": f"{BASE}\nSELECT {KEYS}, {T} AS demand, CAST({T} AS DOUBLE) AS demand_15min_avg, "
    f"CAST(1 AS BIGINT) AS demand_15min_count, CAST(0 AS DOUBLE) AS demand_15min_std, {T} AS demand_15min_min, "
    f"{T} AS demand_15min_max FROM agg15",
    "category_index": CAT_INDEX,
    "time_split_counts": f"{BASE},{FEATS},{ML},\ncut AS (SELECT quantile_cont(epoch_us(timestamp_15min), 0.8) AS c FROM ml)\n"
    "SELECT CASE WHEN epoch_us(timestamp_15min) > c THEN 'test' ELSE 'train' END AS split, count(*) AS rows "
    "FROM ml, cut GROUP BY 1",
    "forecast_errors": PERSIST + "SELECT item_id, store_id, \"timestamp\", actual_demand, predicted_demand, "
    "round(prediction_error, 6) AS prediction_error, round(absolute_error, 6) AS absolute_error FROM results",
    "forecast_metrics": PERSIST + "SELECT round(avg(abs(prediction_error)), 6) AS mae, "
    "round(sqrt(avg(prediction_error * prediction_error)), 6) AS rmse, "
    "round(avg(abs(actual_demand - predicted_demand) / greatest(actual_demand, 1e-6)) * 100, 2) AS mape, "
    "round(avg(actual_demand), 6) AS mean_actual, round(avg(predicted_demand), 6) AS mean_predicted FROM results",
}

FEED_SQL = {
    "calendar_feed": CALENDAR_FEED,
    "calendar_csv_feed": CALENDAR_FEED,
    "sales_feed": SALES_FEED,
    "prices_feed": PRICES_FEED,
    "source_monitor": SOURCE_MONITOR,
    "stream_calendar": CALENDAR_FEED,
    "stream_sales": SALES_FEED,
    "stream_prices": PRICES_FEED,
    "stream_json": CALENDAR_FEED,
    "stream_parquet": PRICES_FEED,
    "stream_sales_json": SALES_FEED,
    "stream_sales_parquet": SALES_FEED,
}



# ---------------------------------------------------------------- dirty inputs, drops, stored tables
def _dirty(sql: str) -> str:
    """The same SQL over the calendar with February a second time, its tenth days with an impossible date."""
    again = """calendar AS (
  SELECT * FROM clean_calendar
  UNION ALL
  SELECT * REPLACE (CASE WHEN date LIKE '%-10' THEN '2011-13-40' ELSE date END AS date) FROM clean_calendar WHERE month = 2
)"""
    assert sql.count("\ncalendar AS (") == 1
    clean = CALENDAR.replace("\ncalendar AS (", "\nclean_calendar AS (")
    return sql.replace(CALENDAR, f"{clean},\n{again}")


DROPPED = ", ".join(
    f"CASE WHEN (store_id = 'CA_1') = {str(i <= 4).lower()} OR {i} BETWEEN 5 AND 8 THEN d_{i} END AS d_{i}" for i in range(1, 13)
)
SALES_DROPS = f"""{with_(SALES_WIDE)}, dropped AS (SELECT * REPLACE ({DROPPED}) FROM sales_wide)
SELECT item_id, dept_id, cat_id, store_id, state_id, day, CAST(sales_quantity AS INTEGER) AS sales_quantity,
       'sales' AS data_source
FROM dropped UNPIVOT INCLUDE NULLS (sales_quantity FOR day IN ({", ".join(DAYS)}))"""

SALES_DIRTY = SALES_FEED.replace("FROM sales_wide UNPIVOT", """FROM (SELECT * REPLACE (
    CASE WHEN item_id NOT LIKE '%7' THEN cat_id END AS cat_id, CASE WHEN item_id NOT LIKE '%7' THEN d_1 END AS d_1)
  FROM sales_wide) UNPIVOT""")

CALENDAR_TYPES = {c: "int" if c in NUMERIC_CAL else "string" for c in CAL_COLS}

CHECK_SQL = {
    "duplicate_dates_dirty": _dirty(PROFILE_SQL["duplicate_dates"]),
    "quality_report_dirty": _dirty(PROFILE_SQL["quality_report"]),
    "date_span_dirty": _dirty(PROFILE_SQL["date_span"]),
    "calendar_feed_dirty": _dirty(CALENDAR_FEED),
    "duplicate_order_dates": "SELECT count(*) - count(DISTINCT CAST(o_orderdate AS DATE)) "
    "- CASE WHEN count(*) > count(o_orderdate) THEN 1 ELSE 0 END AS duplicate_dates FROM orders",
    "column_types": "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(CALENDAR_TYPES.items())) + ') v("position", "column", "type")',
    "sales_drops_csv": SALES_DROPS,
    "sales_drops_json": SALES_DROPS,
    "sales_drops_parquet": SALES_DROPS,
    "sales_feed_dirty": SALES_DIRTY,
    "demand_features_two_levels": DEMAND_SQL["demand_features"],
    "typed_demand_table": DEMAND_SQL["agg_15min"],
    "interval_slots": with_(DEMAND_5MIN) + "\nSELECT interval_5min, CAST(interval_5min // 3 AS INTEGER) AS interval_15min, "
    "count(*) AS rows FROM demand_5min GROUP BY ALL",
    "score_batch_checks": f"{BASE},{FEATS},{ML}\nSELECT count(*) AS rows, CAST(0 AS BIGINT) AS unscored, "
    f"CAST(0 AS BIGINT) AS wrong_errors, CAST(sum(target_{T}_next_1) AS BIGINT) AS actual_sum FROM ml",
    "predict_batch_rows": with_(DEMAND_5MIN) + '\nSELECT item_id, store_id, "timestamp", CAST(demand_5min AS DOUBLE) AS actual_demand, '
    "true AS scored FROM demand_5min",
}

CUT = f"{BASE},{FEATS},{ML},\ncut AS (SELECT quantile_cont(epoch_us(timestamp_15min), 0.8) AS c FROM ml)"
SPLIT_FEATURES = ["hour", "day_of_week", "month", "is_weekend", "is_month_start", "is_month_end"]
STATE_SQL = {
    "train_quality": f"{CUT}\nSELECT count(*) AS test_rows, round(avg(abs(target_{T}_next_1 - {T})), 6) AS persistence_mae, "
    "true AS beats_persistence, true AS stopped_in_time FROM ml, cut WHERE epoch_us(timestamp_15min) > c",
    "first_split": f"""{CUT},
train AS (SELECT ml.*, target_{T}_next_1 - avg(target_{T}_next_1) OVER () AS g FROM ml, cut WHERE epoch_us(timestamp_15min) <= c),
per AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS cut, sum(g) AS g, count(*) AS n FROM train GROUP BY {f}" for f in SPLIT_FEATURES)}),
cum AS (SELECT feature, cut, sum(g) OVER w AS gl, CAST(sum(n) OVER w AS BIGINT) AS nl, sum(g) OVER (PARTITION BY feature) AS ga,
    sum(n) OVER (PARTITION BY feature) AS na FROM per WINDOW w AS (PARTITION BY feature ORDER BY cut)),
gains AS (SELECT feature, cut, nl, gl * gl / nl + (ga - gl) * (ga - gl) / nullif(na - nl, 0) - ga * ga / na AS gain FROM cum WHERE nl >= 20 AND na - nl >= 20),
best AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, cut) AS r FROM gains WHERE gain > 1e-9)
SELECT f.feature, cut, nl AS rows_left, coalesce(round(gain, 3), 0.0) AS gain
FROM (SELECT unnest({SPLIT_FEATURES}) AS feature) f LEFT JOIN best ON best.feature = f.feature AND r = 1""",
    "features_from_state": DEMAND_SQL["demand_features"] + " WHERE date = (SELECT max(date) FROM agg15)",
    "predict_from_state": with_(DEMAND_5MIN) + """
SELECT item_id, store_id, "timestamp", CAST(demand_5min AS DOUBLE) AS actual_demand, count(*) AS rows, true AS same
FROM demand_5min WHERE "timestamp"::DATE = (SELECT max("timestamp"::DATE) FROM demand_5min) GROUP BY ALL""",
    "refreshed_features": DEMAND_SQL["demand_features"],
    "sliding_60min": with_(DEMAND_5MIN) + """
SELECT item_id, store_id, make_timestamp(j * 300000000) AS window_start, make_timestamp(j * 300000000) + INTERVAL 60 MINUTE AS window_end,
       CAST(sum(demand_5min) AS BIGINT) AS demand_60min
FROM (SELECT *, epoch_us("timestamp") // 300000000 AS k FROM demand_5min), unnest(range(k - 11, k + 1)) AS u(j) GROUP BY ALL""",
    "missing_buckets": f"""{BASE}
SELECT item_id, store_id, t + INTERVAL 15 MINUTE AS first_missing, following - INTERVAL 15 MINUTE AS last_missing,
       (epoch_us(following) - epoch_us(t)) // 900000000 - 1 AS buckets
FROM (SELECT item_id, store_id, t, lead(t) OVER (PARTITION BY item_id, store_id ORDER BY t) AS following
      FROM (SELECT DISTINCT item_id, store_id, timestamp_15min AS t FROM agg15 WHERE timestamp_15min IS NOT NULL))
WHERE following > t + INTERVAL 15 MINUTE""",
    "time_range_features": _span_query(),
    "price_quantiles": f"{with_(PRICES)}\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value FROM prices"
        for c in ("sell_price", "wm_yr_wk") for p in (0.01, 0.25, 0.5, 0.75, 0.99)),
    "part_ranks": """
WITH ranks AS (SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS i FROM lineitem GROUP BY l_partkey)
SELECT l_linenumber, CAST(sum(i) AS BIGINT) AS index_sum, count(DISTINCT i) AS labels FROM lineitem JOIN ranks USING (l_partkey) GROUP BY l_linenumber""",
    "stream_batches": f"{PRICES_FEED} WHERE wm_yr_wk % 7 IS DISTINCT FROM 0",
    "stream_set_aside": f"{with_(PRICES)}\nSELECT 'record doesn''t fit the schema' AS reason, store_id, item_id, 'w' || wm_yr_wk AS week FROM prices WHERE wm_yr_wk % 7 = 0",
    "batch_monitor": f"{with_(PRICES)}\nSELECT 'prices' AS data_source, count(*) FILTER (wm_yr_wk % 7 IS DISTINCT FROM 0) AS record_count, "
    "count(*) FILTER (wm_yr_wk % 7 = 0) AS set_aside, true AS times_match FROM prices",
}

ORACLE_SQL: dict[str, str] = {**STATE_SQL, **DEMAND_SQL, **FEED_SQL, **PROFILE_SQL, **CHECK_SQL}
