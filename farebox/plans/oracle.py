"""Independent DuckDB SQL for every oracle-checked query.

The SQL is written from the operator semantics, not generated from the Spark
plans. Tables ``lineitem`` and ``orders`` are views the checker registers.
Spark vs DuckDB differences handled here:

* ``month/hour/dayofweek`` are INTEGER in Spark and BIGINT in DuckDB (cast);
  DuckDB's ``dayofweek`` starts at 0 = Sunday (+1).
* Spark truncates double -> int, DuckDB rounds: ``CAST(TRUNC(x) AS INTEGER)``.
* ``SUM`` of integers is HUGEINT in DuckDB: cast to BIGINT.
* Spark's ``percentile_approx`` on fewer rows than its accuracy is exact and
  equals ``quantile_disc``.
"""

from __future__ import annotations

WINDOW_START = "1997-01-01"
WINDOW_END = "1997-06-01"

_RAW_SELECT = """
  SELECT CAST(l_suppkey AS INTEGER) AS VendorID,
         NULLIF(l_quantity - 1, 13) AS passenger_count,
         l_extendedprice - 2000 AS total_amount,
         o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS tpep_pickup_datetime,
         l_shipdate AS tpep_dropoff_datetime,
         l_quantity AS trip_distance,
         l_returnflag AS store_and_fwd_flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTE = {
    "trips_raw": f"""trips_raw AS ({_RAW_SELECT}
  UNION ALL{_RAW_SELECT}
  WHERE l_orderkey % 50 = 0)""",
    "typed": """typed AS (
  SELECT CAST(VendorID AS INTEGER) AS VendorID,
         TRY_CAST(TRUNC(passenger_count) AS INTEGER) AS passenger_count,
         CAST(total_amount AS DOUBLE) AS total_amount,
         CAST(tpep_pickup_datetime AS TIMESTAMP) AS tpep_pickup_datetime,
         CAST(tpep_dropoff_datetime AS TIMESTAMP) AS tpep_dropoff_datetime
  FROM trips_raw)""",
    "not_null": """not_null AS (
  SELECT * FROM typed
  WHERE VendorID IS NOT NULL AND passenger_count IS NOT NULL
    AND total_amount IS NOT NULL AND NOT isnan(total_amount)
    AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL)""",
    "silver": f"""silver AS (
  SELECT *, CAST(month(tpep_pickup_datetime) AS INTEGER) AS trip_month,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour
  FROM (SELECT DISTINCT * FROM not_null
        WHERE total_amount > 0 AND passenger_count > 0
          AND tpep_dropoff_datetime > tpep_pickup_datetime
          AND tpep_pickup_datetime >= TIMESTAMP '{WINDOW_START}'
          AND tpep_pickup_datetime < TIMESTAMP '{WINDOW_END}'))""",
    "q1": """q1 AS (
  SELECT trip_month, COUNT(*) AS qtd_corridas,
         ROUND(AVG(total_amount), 2) AS receita_media_usd,
         ROUND(SUM(total_amount), 2) AS receita_total_usd
  FROM silver GROUP BY trip_month)""",
    "q2": """q2 AS (
  SELECT pickup_hour, COUNT(*) AS qtd_corridas,
         ROUND(AVG(passenger_count), 3) AS media_passageiros
  FROM silver WHERE trip_month = 5 GROUP BY pickup_hour)""",
}

_ORDER = ["trips_raw", "typed", "not_null", "silver", "q1", "q2"]
_NEEDS = {"typed": ["trips_raw"], "not_null": ["typed"], "silver": ["not_null"],
          "q1": ["silver"], "q2": ["silver"]}


def with_(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding the named CTEs and their prerequisites."""
    wanted: set[str] = set()

    def need(n: str) -> None:
        if n not in wanted:
            wanted.add(n)
            for dep in _NEEDS.get(n, []):
                need(dep)

    for n in names:
        need(n)
    parts = [CTE[n] for n in _ORDER if n in wanted] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"


MONTH_LABEL_SQL = (
    "CASE {m} WHEN 1 THEN 'Jan' WHEN 2 THEN 'Fev' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Abr' "
    "WHEN 5 THEN 'Mai' ELSE CAST({m} AS VARCHAR) END"
)


def cleaning_sql() -> dict[str, str]:
    return {
        "project_required": with_("trips_raw") + """
SELECT VendorID, passenger_count, total_amount, tpep_pickup_datetime, tpep_dropoff_datetime
FROM trips_raw""",
        "cast_types": with_("typed") + "SELECT * FROM typed",
        "filter_not_null": with_("not_null") + "SELECT * FROM not_null",
        "filter_positive_amount": with_("not_null") + "SELECT * FROM not_null WHERE total_amount > 0",
        "filter_positive_passengers": with_("not_null")
        + "SELECT * FROM not_null WHERE passenger_count > 0",
        "filter_chronology": with_("not_null")
        + "SELECT * FROM not_null WHERE tpep_dropoff_datetime > tpep_pickup_datetime",
        "filter_date_window": with_("not_null") + f"""
SELECT * FROM not_null
WHERE tpep_pickup_datetime >= TIMESTAMP '{WINDOW_START}'
  AND tpep_pickup_datetime < TIMESTAMP '{WINDOW_END}'""",
        "dedup_exact": with_("typed") + "SELECT DISTINCT * FROM typed",
        "derive_month_hour": with_("not_null") + """
SELECT *, CAST(month(tpep_pickup_datetime) AS INTEGER) AS trip_month,
       CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour
FROM not_null""",
        "silver_trips": with_("silver") + "SELECT * FROM silver",
        "window_from_months": with_("trips_raw") + """
SELECT CAST(CAST(min(ym) || '-01' AS DATE) AS DATE) AS window_start,
       CAST(CAST(max(ym) || '-01' AS DATE) + INTERVAL 1 MONTH AS DATE) AS window_end
FROM (SELECT DISTINCT strftime(tpep_pickup_datetime, '%Y-%m') AS ym FROM trips_raw)""",
        "month_label": with_("not_null") + f"""
SELECT trip_month, {MONTH_LABEL_SQL.format(m='trip_month')} AS mes
FROM (SELECT DISTINCT CAST(month(tpep_pickup_datetime) AS INTEGER) AS trip_month FROM not_null)""",
    }


def aggregate_sql() -> dict[str, str]:
    return {
        "monthly_revenue": with_("q1") + "SELECT * FROM q1 ORDER BY trip_month",
        "monthly_revenue_sql": with_("q1") + """
SELECT trip_month AS mes, qtd_corridas, receita_media_usd, receita_total_usd FROM q1""",
        "api_sql_equivalence": with_("q1") + """
SELECT CAST(COUNT(*) AS BIGINT) AS left_rows, CAST(COUNT(*) AS BIGINT) AS right_rows,
       CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, TRUE AS equal
FROM q1""",
        "global_avg_amount": with_("silver")
        + "SELECT ROUND(AVG(total_amount), 2) AS media_global_usd FROM silver",
        "mean_of_monthly_means": with_("q1")
        + "SELECT ROUND(AVG(receita_media_usd), 2) AS media_das_medias_usd FROM q1",
        "hourly_passengers": with_("q2") + "SELECT * FROM q2",
        "hourly_passengers_sql": with_("silver") + """
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hora_do_dia, COUNT(*) AS qtd_corridas,
       ROUND(AVG(passenger_count), 3) AS media_passageiros
FROM silver WHERE trip_month = 5 GROUP BY 1""",
        "trips_per_month": with_("silver")
        + 'SELECT trip_month, COUNT(*) AS "count" FROM silver GROUP BY trip_month',
        "profile_ranges": with_("silver") + """
SELECT MIN(total_amount) AS min_amount, MAX(total_amount) AS max_amount,
       ROUND(AVG(total_amount), 2) AS avg_amount,
       MIN(passenger_count) AS min_pax, MAX(passenger_count) AS max_pax
FROM silver""",
        "quantiles_exact": with_("silver") + """
SELECT ROUND(quantile_cont(total_amount, 0.5), 4) AS p50,
       ROUND(quantile_cont(total_amount, 0.9), 4) AS p90,
       ROUND(quantile_cont(total_amount, 0.99), 4) AS p99,
       ROUND(quantile_cont(total_amount, 0.999), 4) AS p999
FROM silver""",
        "tail_distortion": with_("silver") + """
SELECT trip_month AS mes, ROUND(AVG(total_amount), 2) AS media,
       ROUND(quantile_disc(total_amount, 0.5), 2) AS mediana,
       ROUND(AVG(total_amount) - quantile_disc(total_amount, 0.5), 2) AS distorcao_cauda
FROM silver GROUP BY trip_month""",
        "weekday_occupancy": with_("silver") + """
SELECT CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS dia_semana,
       COUNT(*) AS corridas, ROUND(AVG(passenger_count), 3) AS media_pax
FROM silver WHERE trip_month = 5 GROUP BY 1""",
        "vendor_profile": with_("silver") + """
SELECT VendorID, COUNT(*) AS corridas, ROUND(AVG(passenger_count), 3) AS media_pax,
       ROUND(AVG(total_amount), 2) AS ticket_medio
FROM silver GROUP BY VendorID""",
        "layer_counts": with_("silver") + """
SELECT 'bronze' AS camada, COUNT(*) AS linhas FROM trips_raw
UNION ALL SELECT 'silver', COUNT(*) FROM silver
UNION ALL SELECT 'gold_trips', COUNT(*) FROM silver""",
        "total_trips": with_("q1")
        + "SELECT CAST(SUM(qtd_corridas) AS BIGINT) AS total_corridas FROM q1",
        "peak_month": with_("q1") + f"""
SELECT trip_month AS mes_num, {MONTH_LABEL_SQL.format(m='trip_month')} AS mes, receita_media_usd
FROM q1 ORDER BY receita_media_usd DESC, trip_month ASC LIMIT 1""",
        "peak_low_hour": with_("q2") + """
SELECT p.pickup_hour AS hora_pico, p.media_passageiros AS media_pico,
       l.pickup_hour AS hora_minima, l.media_passageiros AS media_minima
FROM (SELECT * FROM q2 ORDER BY media_passageiros DESC, pickup_hour LIMIT 1) p,
     (SELECT * FROM q2 ORDER BY media_passageiros ASC, pickup_hour LIMIT 1) l""",
        "weighted_passengers": with_("q2") + """
SELECT ROUND(SUM(media_passageiros * qtd_corridas) / SUM(qtd_corridas), 4) AS media_ponderada_pax
FROM q2""",
        "growth_first_last": with_("q1") + """
SELECT MIN(trip_month) AS mes_inicial, MAX(trip_month) AS mes_final,
       ROUND((arg_max(receita_media_usd, trip_month) / arg_min(receita_media_usd, trip_month)
              - 1.0) * 100.0, 1) AS crescimento_pct
FROM q1""",
        "demand_intensity": with_("q2") + """
SELECT pickup_hour, qtd_corridas,
       ROUND(qtd_corridas / MAX(qtd_corridas) OVER (), 4) AS intensidade
FROM q2""",
        "kpi_snapshot": with_("silver") + """
SELECT trip_month, COUNT(*) AS qtd_corridas, ROUND(AVG(total_amount), 2) AS receita_media_usd,
       CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS linhas
FROM silver GROUP BY trip_month""",
    }
