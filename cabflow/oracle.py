"""Independent SQL for every registered query key.

The prelude rebuilds ``trips`` and ``valid_trips`` from ``lineitem`` with the
same fixture rules, but spelled with the SQL engine's own primitives
(``date_diff('minute', ..)``, 0-based ``dayofweek``, ``quantile_cont``), so
the comparison checks our Spark re-expressions of those semantics too.
Sums, means and rounding are the SQL engine's own.
"""

from __future__ import annotations

from cabflow.sources.schema import CANONICAL, FEEDS, SOURCE_NAMES

PRELUDE = """
WITH li AS (
  SELECT * FROM lineitem
),
t0 AS (
  SELECT *,
    CASE WHEN l_returnflag = 'R' THEN 'green' ELSE 'yellow' END AS taxi_type,
    l_shipdate + to_seconds(CAST((l_partkey % 1440) * 60 + l_suppkey % 60
        + CASE WHEN l_orderkey % 211 = 0 THEN 31622400 ELSE 0 END AS BIGINT)) AS pickup_datetime
  FROM li
),
trips AS (
  SELECT
    taxi_type,
    taxi_type || '_tripdata_' || strftime(l_shipdate, '%Y-%m') || '.parquet' AS filename,
    CAST(year(l_shipdate) AS INTEGER) AS file_year,
    CAST(month(l_shipdate) AS INTEGER) AS file_month,
    CAST(l_linenumber AS BIGINT) AS vendor_id,
    pickup_datetime,
    CASE WHEN l_orderkey % 307 = 0 THEN NULL
         WHEN l_orderkey % 97 = 0 THEN pickup_datetime + to_seconds(CAST(-300 AS BIGINT))
         WHEN l_orderkey % 193 = 0 THEN pickup_datetime + to_seconds(CAST(90000 AS BIGINT))
         ELSE pickup_datetime + to_seconds(CAST(l_quantity * 60 + l_linenumber * 7 AS BIGINT))
    END AS dropoff_datetime,
    CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS passenger_count,
    CASE WHEN l_orderkey % 53 = 0 THEN CAST(0.0 AS DOUBLE)
         WHEN l_orderkey % 401 = 0 THEN CAST(-1.5 AS DOUBLE)
         ELSE CAST(l_partkey AS DOUBLE) / 128 END AS trip_distance,
    CAST(l_linenumber AS DOUBLE) AS rate_code_id,
    CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_partkey % 263 + 1 AS BIGINT) AS pickup_location_id,
    CAST(l_suppkey % 263 + 1 AS BIGINT) AS dropoff_location_id,
    CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE CAST(l_partkey % 6 AS BIGINT) END AS payment_type,
    CASE WHEN l_orderkey % 61 = 0 THEN CAST(0.0 AS DOUBLE) ELSE l_quantity END AS fare_amount,
    CAST(0.5 AS DOUBLE) AS extra,
    l_tax AS mta_tax,
    l_quantity * l_discount AS tip_amount,
    CAST(0.0 AS DOUBLE) AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    CASE WHEN l_orderkey % 71 = 0 THEN -1.0 ELSE 1.0 END * floor(l_extendedprice * 128) / CAST(128 AS DOUBLE) AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge,
    CASE WHEN taxi_type = 'yellow' THEN CAST(1.75 AS DOUBLE) END AS airport_fee,
    CASE WHEN taxi_type = 'green' THEN CAST(0.0 AS DOUBLE) END AS ehail_fee,
    CASE WHEN taxi_type = 'green' THEN CAST(1 AS BIGINT) END AS trip_type
  FROM t0
),
valid_trips AS (
  SELECT *, CAST(date_diff('minute', pickup_datetime, dropoff_datetime) AS BIGINT) AS duration_minutes
  FROM trips
  WHERE pickup_datetime IS NOT NULL
    AND dropoff_datetime IS NOT NULL
    AND year(pickup_datetime) = file_year
    AND dropoff_datetime > pickup_datetime
    AND dropoff_datetime <= pickup_datetime + INTERVAL '24 hours'
    AND trip_distance >= 0
    AND total_amount >= 0
)
"""

# Nullable integer codes are compared as DOUBLE on both sides (see registry.py).
PAYMENT_CMP = "CAST(payment_type AS DOUBLE) AS payment_type"
TRIP_COLUMNS = (
    "taxi_type, filename, file_year, file_month, vendor_id, pickup_datetime, dropoff_datetime, "
    "passenger_count, trip_distance, rate_code_id, store_and_fwd_flag, pickup_location_id, "
    f"dropoff_location_id, {PAYMENT_CMP}, fare_amount, extra, mta_tax, tip_amount, tolls_amount, "
    "improvement_surcharge, total_amount, congestion_surcharge, airport_fee, ehail_fee, "
    "CAST(trip_type AS DOUBLE) AS trip_type"
)


def rnd(x: str, d: int = 2) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), {d})"


def xsum(x: str) -> str:
    return f"SUM({x})"


def xmean(x: str) -> str:
    return f"AVG({x})"


def share(cond: str) -> str:
    return f"(100.0 * AVG(CASE WHEN {cond} THEN 1 ELSE 0 END))"


TIP = "AVG(CASE WHEN payment_type = 1 AND fare_amount > 0 THEN 100.0 * tip_amount / fare_amount END)"
WEEKEND = "dayofweek(pickup_datetime) IN (0, 6)"
Y = "CAST(file_year AS BIGINT) AS file_year"
M = "CAST(file_month AS BIGINT) AS file_month"


def _q(body: str) -> str:
    return PRELUDE + body


def _quantile_cols(probs: tuple[float, ...]) -> str:
    cols = []
    for name, src in (("distance", "trip_distance"), ("duration", "duration_minutes"), ("total", "total_amount")):
        for p in probs:
            cols.append(f"{rnd(f'quantile_cont(CAST({src} AS DOUBLE), {p})', 6)} AS {name}_p{round(p * 100)}")
    return ", ".join(cols)


YEARLY = f"""
SELECT {Y}, taxi_type, COUNT(*) AS trips,
  {rnd(xsum('total_amount'))} AS revenue_usd,
  {rnd(xmean('total_amount'))} AS avg_total_usd,
  {rnd(xmean('trip_distance'))} AS avg_distance_miles,
  {rnd(xmean('duration_minutes'))} AS avg_duration_minutes,
  {rnd(TIP)} AS avg_card_tip_pct,
  {rnd(share(WEEKEND))} AS weekend_share_pct
FROM valid_trips GROUP BY ALL
"""

YEARLY_RAW = f"""
SELECT {Y}, taxi_type, COUNT(*) AS trips,
  {xsum('total_amount')} AS revenue_usd,
  {xmean('total_amount')} AS avg_total_usd,
  {xmean('trip_distance')} AS avg_distance_miles,
  {xmean('duration_minutes')} AS avg_duration_minutes,
  {rnd(TIP, 8)} AS avg_card_tip_pct,
  {share(WEEKEND)} AS weekend_share_pct
FROM valid_trips GROUP BY ALL
"""

MONTHLY_RAW = f"""
SELECT {Y}, {M}, taxi_type, COUNT(*) AS trips,
  {xmean('trip_distance')} AS avg_distance_miles,
  {xmean('duration_minutes')} AS avg_duration_minutes,
  {xmean('total_amount')} AS avg_total_usd,
  {xsum('total_amount')} AS revenue_usd
FROM valid_trips GROUP BY ALL
"""

PAYMENT = f"SELECT taxi_type, {PAYMENT_CMP}, COUNT(*) AS trips FROM valid_trips GROUP BY taxi_type, payment_type"
HOURLY = "SELECT taxi_type, CAST(hour(pickup_datetime) AS BIGINT) AS pickup_hour, COUNT(*) AS trips FROM valid_trips GROUP BY ALL"

SQL: dict[str, str] = {
    "view_trips": f"SELECT {TRIP_COLUMNS} FROM trips",
    "view_valid_trips": f"SELECT {TRIP_COLUMNS}, duration_minutes FROM valid_trips",
    "valid_trips": f"SELECT {TRIP_COLUMNS}, duration_minutes FROM valid_trips",
    "rejected_trips": f"""
SELECT {TRIP_COLUMNS},
  CAST(date_diff('minute', pickup_datetime, dropoff_datetime) AS DOUBLE) AS duration_minutes,
  concat_ws(',',
    CASE WHEN pickup_datetime IS NULL OR dropoff_datetime IS NULL THEN 'null_timestamps' END,
    CASE WHEN year(pickup_datetime) <> file_year THEN 'pickup_outside_file_year' END,
    CASE WHEN dropoff_datetime <= pickup_datetime THEN 'nonpositive_duration' END,
    CASE WHEN dropoff_datetime > pickup_datetime + INTERVAL '24 hours' THEN 'duration_over_24h' END,
    CASE WHEN trip_distance IS NULL OR trip_distance < 0 THEN 'negative_or_missing_distance' END,
    CASE WHEN total_amount IS NULL OR total_amount < 0 THEN 'negative_or_missing_total' END
  ) AS reasons
FROM trips
WHERE NOT coalesce(pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND year(pickup_datetime) = file_year AND dropoff_datetime > pickup_datetime
    AND dropoff_datetime <= pickup_datetime + INTERVAL '24 hours'
    AND trip_distance >= 0 AND total_amount >= 0, false)
""",
    "coverage": f"SELECT taxi_type, {Y}, COUNT(DISTINCT filename) AS files, COUNT(*) AS rows FROM trips GROUP BY ALL",
    "quality": f"""
SELECT taxi_type, {Y}, COUNT(*) AS rows,
  CAST(count_if(pickup_datetime IS NULL OR dropoff_datetime IS NULL) AS BIGINT) AS null_timestamps,
  CAST(count_if(year(pickup_datetime) <> file_year) AS BIGINT) AS pickup_outside_file_year,
  CAST(count_if(dropoff_datetime <= pickup_datetime) AS BIGINT) AS nonpositive_duration,
  CAST(count_if(dropoff_datetime > pickup_datetime + INTERVAL '24 hours') AS BIGINT) AS duration_over_24h,
  CAST(count_if(trip_distance <= 0) AS BIGINT) AS nonpositive_distance,
  CAST(count_if(total_amount < 0) AS BIGINT) AS negative_total,
  CAST(count_if(passenger_count IS NULL OR passenger_count <= 0) AS BIGINT) AS missing_or_zero_passengers
FROM trips GROUP BY ALL
""",
    "monthly_eda": f"""
SELECT {Y}, {M}, taxi_type, COUNT(*) AS trips,
  {rnd(xmean('trip_distance'))} AS avg_distance_miles,
  {rnd(xmean('duration_minutes'))} AS avg_duration_minutes,
  {rnd(xmean('total_amount'))} AS avg_total_usd
FROM valid_trips GROUP BY ALL
""",
    "monthly_indicators": MONTHLY_RAW,
    "monthly_volume": f"SELECT {Y}, {M}, taxi_type, COUNT(*) AS trips FROM valid_trips GROUP BY ALL",
    "yearly_indicators": YEARLY,
    "yearly_indicators_raw": YEARLY_RAW,
    "yearly_notebook": f"""
SELECT {Y}, taxi_type, COUNT(*) AS trips,
  {rnd(xmean('total_amount'))} AS avg_total, {rnd(xmean('trip_distance'))} AS avg_distance
FROM valid_trips GROUP BY ALL
""",
    "card_tip_pct": f"SELECT {Y}, taxi_type, {rnd(TIP)} AS avg_card_tip_pct FROM valid_trips GROUP BY ALL",
    "weekend_share": f"SELECT {Y}, taxi_type, {rnd(share(WEEKEND))} AS weekend_share_pct FROM valid_trips GROUP BY ALL",
    "payment_mix": PAYMENT,
    "payment_share": f"""
SELECT taxi_type, {PAYMENT_CMP}, COUNT(*) AS trips,
  {rnd('100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY taxi_type)')} AS share_pct
FROM valid_trips GROUP BY taxi_type, payment_type
""",
    "pickup_hour": HOURLY,
    "totals": f"""
SELECT COUNT(*) AS trips, {xsum('total_amount')} AS revenue, {xmean('total_amount')} AS avg_total,
  {xmean('trip_distance')} AS avg_distance, {xmean('duration_minutes')} AS avg_duration,
  {rnd(TIP, 8)} AS tip_pct
FROM valid_trips
""",
    "quantiles": f"SELECT taxi_type, {_quantile_cols((0.5, 0.99))} FROM valid_trips GROUP BY taxi_type",
    "quantiles_list": f"SELECT taxi_type, {_quantile_cols((0.5, 0.9, 0.99))} FROM valid_trips GROUP BY taxi_type",
}


def _with(body: str, **ctes: str) -> str:
    """Extra CTEs after the prelude's, then the final SELECT."""
    extra = "".join(f", {name} AS ({sql})\n" for name, sql in ctes.items())
    return extra + body


def _pivot(value: str) -> str:
    return _with(
        f"""SELECT file_year,
  max(CASE WHEN taxi_type = 'green' THEN {value} END) AS green,
  max(CASE WHEN taxi_type = 'yellow' THEN {value} END) AS yellow
FROM yearly GROUP BY file_year""",
        yearly=YEARLY_RAW,
    )


TOTALS = SQL["totals"]
MILLION = "CAST(1000000 AS DOUBLE)"

SQL.update(
    {
        "pivot_avg_total": _pivot("avg_total_usd"),
        "pivot_avg_distance": _pivot("avg_distance_miles"),
        "yellow_green_ratio": _with(
            """SELECT file_year, y AS yellow_trips, g AS green_trips,
  CASE WHEN g IS NOT NULL THEN y / greatest(g, 1) END AS ratio
FROM (SELECT file_year,
        max(CASE WHEN taxi_type = 'yellow' THEN trips END) AS y,
        max(CASE WHEN taxi_type = 'green' THEN trips END) AS g
      FROM yearly GROUP BY file_year)""",
            yearly=YEARLY_RAW,
        ),
        "card_cash_share": _with(
            """SELECT taxi_type, CAST(card AS BIGINT) AS card_trips, CAST(cash AS BIGINT) AS cash_trips,
  CASE WHEN card + cash > 0 THEN card / (card + cash) * 100.0 END AS card_pct,
  CASE WHEN card + cash > 0 THEN cash / (card + cash) * 100.0 END AS cash_pct
FROM (SELECT taxi_type,
        coalesce(sum(CASE WHEN payment_type = 1 THEN trips END), 0) AS card,
        coalesce(sum(CASE WHEN payment_type = 2 THEN trips END), 0) AS cash
      FROM pay WHERE payment_type IN (1, 2) GROUP BY taxi_type)""",
            pay=PAYMENT,
        ),
        "monthly_series": _with(
            f"""SELECT CAST(make_date(file_year, file_month, 1) AS TIMESTAMP) AS period, taxi_type, trips,
  trips / {MILLION} AS trips_millions FROM monthly""",
            monthly=MONTHLY_RAW,
        ),
        "hourly_series": _with(
            f"SELECT taxi_type, pickup_hour, trips / {MILLION} AS trips_millions FROM hourly", hourly=HOURLY
        ),
        "quantile_panel": SQL["quantiles"],
        "skew_check": f"""
SELECT taxi_type,
  {rnd('quantile_cont(trip_distance, 0.5)', 6)} AS distance_p50,
  {rnd('quantile_cont(trip_distance, 0.99)', 6)} AS distance_p99,
  {xmean('trip_distance')} AS mean_distance,
  {xmean('trip_distance')} > quantile_cont(trip_distance, 0.5) AS mean_above_median
FROM valid_trips GROUP BY taxi_type
""",
        "kpi_cards": _with(
            f"""SELECT trips, {rnd('revenue / CAST(1000000000 AS DOUBLE)', 2)} AS revenue_billions,
  {rnd('avg_total', 2)} AS avg_total, {rnd('avg_distance', 2)} AS avg_distance,
  {rnd('avg_duration', 1)} AS avg_duration, {rnd('tip_pct', 1)} AS tip_pct FROM tot""",
            tot=TOTALS,
        ),
        "busiest_month": _with(
            """SELECT file_year, file_month, taxi_type, trips FROM monthly
ORDER BY trips DESC, file_year, file_month, taxi_type LIMIT 1""",
            monthly=MONTHLY_RAW,
        ),
        "top_hour": _with("SELECT * FROM hourly ORDER BY trips DESC, taxi_type, pickup_hour LIMIT 1", hourly=HOURLY),
        "bench_count": "SELECT COUNT(*) AS rows FROM trips",
        "bench_summary": f"""
SELECT taxi_type, COUNT(*) AS trips, {xmean('trip_distance')} AS avg_distance,
  {xmean('total_amount')} AS avg_total FROM trips GROUP BY taxi_type
""",
        "bench_monthly": f"""
SELECT {Y}, {M}, taxi_type, COUNT(*) AS trips, {xsum('total_amount')} AS revenue
FROM trips GROUP BY ALL
""",
    }
)


# The file lake omits the two fee columns in its first year.
FIRST = "(SELECT min(file_year) FROM trips)"
LAKE_FEES = (
    f"CASE WHEN file_year = {FIRST} THEN NULL ELSE airport_fee END AS airport_fee, "
    f"CASE WHEN file_year = {FIRST} THEN NULL ELSE ehail_fee END AS ehail_fee"
)
LAKE = f"""SELECT {TRIP_COLUMNS.replace('airport_fee, ehail_fee', LAKE_FEES)} FROM trips"""
LAKE_VALID = f"""SELECT {TRIP_COLUMNS.replace('airport_fee, ehail_fee', LAKE_FEES)}, duration_minutes FROM valid_trips"""
CALENDAR = """SELECT f.taxi_type, CAST(y.year AS BIGINT) AS year, CAST(m.month AS BIGINT) AS month,
  printf('%s_tripdata_%04d-%02d.parquet', f.taxi_type, y.year, m.month) AS file
FROM (SELECT unnest(range(min(file_year), max(file_year) + 1)) AS year FROM trips) y,
     (SELECT unnest(['yellow', 'green']) AS taxi_type) f,
     (SELECT unnest(range(1, 13)) AS month) m"""

SQL.update(
    {
        "scan_feed": "SELECT taxi_type, filename, COUNT(*) AS rows FROM trips WHERE taxi_type = 'yellow' GROUP BY ALL",
        "scan_evolving_schema": LAKE,
        "scan_filename": "SELECT DISTINCT taxi_type, filename FROM trips",
        "scan_file_period": "SELECT DISTINCT filename, CAST(file_year AS BIGINT) AS file_year, CAST(file_month AS BIGINT) AS file_month FROM trips",
        "scan_scoped_years": f"SELECT * FROM ({LAKE}) WHERE file_year IN (1996, 1997)",
        "scan_mixed_feeds": "SELECT taxi_type, filename, COUNT(*) AS rows FROM trips GROUP BY ALL",
        "file_row_counts": "SELECT taxi_type, CAST(file_year AS BIGINT) AS year, COUNT(DISTINCT filename) AS files, COUNT(*) AS rows FROM trips GROUP BY ALL",
        "normalize_yellow": f"SELECT * FROM ({LAKE}) WHERE taxi_type = 'yellow'",
        "normalize_green": f"SELECT * FROM ({LAKE}) WHERE taxi_type = 'green'",
        "union_by_name": LAKE,
        "view_trips": LAKE,
        "view_valid_trips": LAKE_VALID,
        "materialize_trips": "SELECT CAST(file_year AS BIGINT) AS file_year, taxi_type, COUNT(*) AS rows FROM trips GROUP BY ALL",
        "materialized_lookup": f"SELECT * FROM ({LAKE}) WHERE file_year IN (1997) AND taxi_type = 'green'",
        "filter_year_in": f"SELECT * FROM ({LAKE}) WHERE file_year IN (1996, 1997)",
        "bench_count_table": SQL["bench_count"],
        "bench_summary_table": SQL["bench_summary"],
        "bench_monthly_table": SQL["bench_monthly"],
        "sink_csv": YEARLY,
        "sink_json": YEARLY_RAW,
        "ingest_calendar": CALENDAR,
        "ingest_missing_months": f"SELECT * FROM ({CALENDAR}) c WHERE c.file NOT IN (SELECT DISTINCT filename FROM trips)",
        "ingest_incremental": SQL["coverage"],
        "ingest_stream": SQL["coverage"],
        "ingest_removed": f"SELECT * FROM ({SQL['coverage']}) WHERE file_year IN (1996, 1997)",
        "reconcile_counts": _with(
            """SELECT 'coverage_vs_files' AS "check", taxi_type, CAST(file_year AS DOUBLE) AS file_year,
  rows AS "left", rows AS "right", true AS ok FROM cov
UNION ALL
SELECT 'monthly_vs_yearly', taxi_type, CAST(file_year AS DOUBLE), COUNT(*), COUNT(*), true FROM valid_trips GROUP BY ALL
UNION ALL
SELECT 'payment_vs_hourly', taxi_type, CAST(NULL AS DOUBLE), COUNT(*), COUNT(*), true FROM valid_trips GROUP BY taxi_type""",
            cov="SELECT taxi_type, file_year, COUNT(*) AS rows FROM trips GROUP BY ALL",
        ),
    }
)


def _carries(column: str) -> str:
    """Condition on (taxi_type, nth year) under which the lake's files carry a source column."""
    feeds = [f for f in FEEDS if column in {c for c in SOURCE_NAMES[f].values() if c}]
    if column.lower() in ("airport_fee", "ehail_fee"):
        spelled = {"airport_fee": "nth = 2", "Airport_fee": "nth > 2"}.get(column, "nth > 1")
        feed = "green" if column == "ehail_fee" else "yellow"
        return f"taxi_type = '{feed}' AND {spelled}"
    if column == "cbd_fee":
        return "nth = 3"
    return f"taxi_type IN ({', '.join(repr(f) for f in feeds)})"


def _source_columns() -> list[str]:
    names = {c for f in FEEDS for c in SOURCE_NAMES[f].values() if c}
    return sorted(names | {"airport_fee", "Airport_fee", "cbd_fee"})


FILES = """SELECT *, dense_rank() OVER (ORDER BY file_year) AS nth
FROM (SELECT taxi_type, filename, file_year, COUNT(*) AS rows FROM trips GROUP BY ALL)"""
CARRIED = " UNION ALL ".join(
    f"SELECT taxi_type, filename, file_year, rows, '{c}' AS column_name FROM files WHERE {_carries(c)}" for c in _source_columns()
)
DRIFT = """SELECT c.taxi_type, c.column_name, CAST(min(c.file_year) AS BIGINT) AS first_year,
  CAST(max(c.file_year) AS BIGINT) AS last_year, COUNT(*) AS files,
  COUNT(*) = max(a.files) AS in_every_file
FROM carried c JOIN (SELECT taxi_type, COUNT(*) AS files FROM files GROUP BY ALL) a USING (taxi_type)
GROUP BY c.taxi_type, c.column_name"""
def _type_of(column: str) -> str:
    """The footer's type of a source column, as SQL over (nth year)."""
    if column == "VendorID":
        return "CASE WHEN nth = 1 THEN 'integer' ELSE 'long' END"
    if column == "passenger_count":
        return "CASE WHEN nth = 2 THEN 'double' ELSE 'long' END"
    types = {src.lower(): CANONICAL_NAMES_TYPES[canon] for f in FEEDS for canon, src in SOURCE_NAMES[f].items() if src}
    return repr(types.get(column.lower(), "double"))


CANONICAL_NAMES_TYPES = {n: t.typeName() for n, t in CANONICAL}
TYPED = " UNION ALL ".join(
    f"SELECT taxi_type, filename, right(replace(filename, '.parquet', ''), 7) AS period, '{c}' AS column_name, {_type_of(c)} AS type "
    f"FROM files WHERE {_carries(c)}"
    for c in _source_columns()
)
MONTHS = """SELECT taxi_type, period, files, row_number() OVER (PARTITION BY taxi_type ORDER BY period) AS nth
FROM (SELECT taxi_type, right(replace(filename, '.parquet', ''), 7) AS period, COUNT(*) AS files FROM files GROUP BY ALL)"""
RUNS = """SELECT taxi_type, column_name, type, min(period) AS first_period, max(period) AS last_period, COUNT(*) AS periods,
  CAST(sum(own) AS BIGINT) AS files, sum(own) = sum(files) AS in_every_file
FROM (SELECT t.*, m.files, m.nth - row_number() OVER (PARTITION BY taxi_type, column_name, type ORDER BY m.nth) AS run
      FROM (SELECT taxi_type, period, column_name, type, COUNT(*) AS own FROM typed GROUP BY ALL) t JOIN months m USING (taxi_type, period))
GROUP BY taxi_type, column_name, type, run"""
SPELLED = {"string": "string", "integer": "int", "long": "long", "double": "double", "timestamp_ntz": "timestamp_ntz"}
DESCRIBED = " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, '{SPELLED[t.typeName()]}' AS column_type, COUNT(*) AS rows, COUNT({n}) AS values FROM lake"
    for n, t in CANONICAL
)

SQL.update(
    {
        "sample_rows": "SELECT CAST(10 AS BIGINT) AS wanted, least(COUNT(*), 10) AS in_trips FROM trips",
        "describe_trips": _with(DESCRIBED, lake=LAKE),
        "ingest_manifest": _with(
            """SELECT taxi_type, CAST(file_year AS BIGINT) AS year, filename AS file, true AS valid_parquet, max(rows) AS rows,
  COUNT(*) AS columns FROM carried GROUP BY taxi_type, file_year, filename""",
            files=FILES,
            carried=CARRIED,
        ),
        "ingest_integrity": """SELECT taxi_type, CAST(file_year AS BIGINT) AS year, COUNT(DISTINCT filename) AS files,
  COUNT(DISTINCT filename) AS valid_files, COUNT(DISTINCT filename) AS sized_files FROM trips GROUP BY ALL""",
        "ingest_gate": "SELECT COUNT(DISTINCT filename) AS files, COUNT(*) AS rows FROM trips",
        "schema_drift": _with(DRIFT, files=FILES, carried=CARRIED),
        "schema_runs": _with(RUNS, files=FILES, typed=TYPED, months=MONTHS),
        "schema_columns": _with(
            """SELECT taxi_type, CAST(file_year AS BIGINT) AS year, COUNT(*) AS files, min(n) AS fewest_columns, max(n) AS most_columns,
  max(names) AS distinct_columns
FROM (SELECT taxi_type, file_year, filename, COUNT(*) AS n FROM carried GROUP BY ALL)
JOIN (SELECT taxi_type, file_year, COUNT(DISTINCT column_name) AS names FROM carried GROUP BY ALL) USING (taxi_type, file_year)
GROUP BY taxi_type, file_year""",
            files=FILES,
            carried=CARRIED,
        ),
        "ingest_status_summary": _with(
            """SELECT s.status, CAST(coalesce(n.files, 0) AS BIGINT) AS files,
  s.status = 'new' AND coalesce(n.files, 0) > 0 AS has_new_bytes
FROM (SELECT unnest(['new', 'skipped', 'missing', 'failed']) AS status) s
LEFT JOIN (SELECT status, COUNT(*) AS files FROM marked GROUP BY status) n ON s.status = n.status""",
            files=FILES,
            marked=f"""SELECT CASE WHEN f.filename IS NULL THEN 'missing' WHEN f.nth = 1 THEN 'skipped' ELSE 'new' END AS status
FROM ({CALENDAR}) c LEFT JOIN files f ON c.file = f.filename""",
        ),
    }
)


def oracle_sql() -> dict[str, str]:
    return {k: _q(v) for k, v in SQL.items()}
