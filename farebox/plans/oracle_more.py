"""DuckDB oracle SQL, part 2: quality, incremental, snapshots, sinks, landing,
documents, streaming."""

from __future__ import annotations

from farebox.plans.oracle import MONTH_LABEL_SQL, WINDOW_END, WINDOW_START, with_

REQ = ["VendorID", "passenger_count", "total_amount", "tpep_pickup_datetime",
       "tpep_dropoff_datetime"]
KEY_MATCH = ("{a}.VendorID = {b}.VendorID AND {a}.tpep_pickup_datetime = {b}.tpep_pickup_datetime"
             " AND {a}.tpep_dropoff_datetime = {b}.tpep_dropoff_datetime"
             " AND {a}.trip_month = {b}.trip_month")

METRICS = """metrics AS (
  SELECT COUNT(*) AS rows_seen,
         COUNT(*) FILTER (WHERE VendorID IS NULL) AS missing_VendorID,
         COUNT(*) FILTER (WHERE passenger_count IS NULL) AS missing_passenger_count,
         COUNT(*) FILTER (WHERE total_amount IS NULL) AS missing_total_amount,
         COUNT(*) FILTER (WHERE tpep_pickup_datetime IS NULL) AS missing_tpep_pickup_datetime,
         COUNT(*) FILTER (WHERE tpep_dropoff_datetime IS NULL) AS missing_tpep_dropoff_datetime,
         COUNT(*) FILTER (WHERE total_amount <= 0) AS amount_not_positive,
         COUNT(*) FILTER (WHERE passenger_count <= 0) AS passengers_not_positive,
         COUNT(*) FILTER (WHERE tpep_dropoff_datetime <= tpep_pickup_datetime) AS dropoff_not_after
  FROM {src})"""

_OFFENDERS = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN missing_{c} > 0 THEN '{c}=' || CAST(missing_{c} AS VARCHAR) END" for c in REQ) + ")"

REPORT = f"""
SELECT 'colunas_obrigatorias_presentes' AS "check", CAST(0 AS BIGINT) AS metric, TRUE AS passed,
       TRUE AS critical, 'ok' AS detail
UNION ALL SELECT 'dataset_nao_vazio', rows_seen, rows_seen > 0, TRUE,
       'linhas: ' || CAST(rows_seen AS VARCHAR) FROM metrics
UNION ALL SELECT 'sem_nulos_em_obrigatorias',
       CAST({' + '.join('missing_' + c for c in REQ)} AS BIGINT),
       greatest({', '.join('missing_' + c for c in REQ)}, 0) = 0, TRUE,
       CASE WHEN {_OFFENDERS} = '' THEN 'ok' ELSE 'nulos: ' || {_OFFENDERS} END FROM metrics
UNION ALL SELECT 'total_amount_positivo', amount_not_positive, amount_not_positive = 0, TRUE,
       CAST(amount_not_positive AS VARCHAR) || ' linhas <= 0' FROM metrics
UNION ALL SELECT 'passenger_count_positivo', passengers_not_positive, passengers_not_positive = 0, TRUE,
       CAST(passengers_not_positive AS VARCHAR) || ' linhas <= 0' FROM metrics
UNION ALL SELECT 'dropoff_apos_pickup', dropoff_not_after, dropoff_not_after = 0, TRUE,
       CAST(dropoff_not_after AS VARCHAR) || ' viagens invertidas' FROM metrics"""

SCENARIO = [
    """uniq AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, trip_month
    ORDER BY total_amount DESC, passenger_count DESC, pickup_hour DESC) AS rn FROM silver) WHERE rn = 1)""",
    """target AS (SELECT * FROM uniq WHERE VendorID % 3 <> 2)""",
    """source AS (
  SELECT VendorID, passenger_count,
         CASE WHEN VendorID % 2 = 0 THEN total_amount + 1 ELSE total_amount * 0.5::DOUBLE END AS total_amount,
         tpep_pickup_datetime, tpep_dropoff_datetime, trip_month, pickup_hour
  FROM uniq WHERE VendorID % 3 = 1
  UNION ALL SELECT * FROM uniq WHERE VendorID % 3 = 2)""",
    f"""upserted AS (
  SELECT * FROM source
  UNION ALL SELECT * FROM target t
  WHERE NOT EXISTS (SELECT 1 FROM source s WHERE {KEY_MATCH.format(a='s', b='t')}))""",
]

#: The target, the late rows, and what comes back of them (lowered, or deleted), as three versions.
THREE_MERGES = [
    "late AS (SELECT * FROM source WHERE trip_month >= 4)",
    """back AS (
  SELECT * REPLACE (total_amount * 0.125::DOUBLE AS total_amount), pickup_hour = 0 AS gone
  FROM late WHERE VendorID % 3 = 2 AND pickup_hour % 2 = 0)""",
    f"""v1 AS (
  SELECT * FROM late
  UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM late s WHERE {KEY_MATCH.format(a='s', b='t')}))""",
    f"""v2 AS (
  SELECT * EXCLUDE (gone) FROM back WHERE NOT gone
  UNION ALL SELECT * FROM v1 t WHERE NOT EXISTS (SELECT 1 FROM back s WHERE {KEY_MATCH.format(a='s', b='t')}))""",
]

CHANGE_FEED = f"""
SELECT n.*, 'insert' AS _change_type, 1 AS version FROM late n
WHERE NOT EXISTS (SELECT 1 FROM target o WHERE {KEY_MATCH.format(a='o', b='n')})
UNION ALL SELECT o.*, 'update_preimage', 1 FROM target o
WHERE EXISTS (SELECT 1 FROM late n WHERE {KEY_MATCH.format(a='o', b='n')})
UNION ALL SELECT n.*, 'update_postimage', 1 FROM late n
WHERE EXISTS (SELECT 1 FROM target o WHERE {KEY_MATCH.format(a='o', b='n')})
UNION ALL SELECT o.*, CASE WHEN n.gone THEN 'delete' ELSE 'update_preimage' END, 2
FROM v1 o JOIN back n ON {KEY_MATCH.format(a='o', b='n')}
UNION ALL SELECT * EXCLUDE (gone), 'update_postimage', 2 FROM back WHERE NOT gone"""

_DIFFERS = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}"
                       for c in ["passenger_count", "total_amount", "pickup_hour"])

CHANGE_SET = f"""
SELECT n.*, 'insert' AS _change_type FROM upserted n
WHERE NOT EXISTS (SELECT 1 FROM target o WHERE {KEY_MATCH.format(a='o', b='n')})
UNION ALL SELECT o.*, 'delete' FROM target o
WHERE NOT EXISTS (SELECT 1 FROM upserted n WHERE {KEY_MATCH.format(a='o', b='n')})
UNION ALL SELECT o.*, 'update_preimage' FROM target o JOIN upserted n ON {KEY_MATCH.format(a='o', b='n')}
WHERE {_DIFFERS}
UNION ALL SELECT n.*, 'update_postimage' FROM target o JOIN upserted n ON {KEY_MATCH.format(a='o', b='n')}
WHERE {_DIFFERS}"""

Q1_OF = """SELECT trip_month, COUNT(*) AS qtd_corridas, ROUND(AVG(total_amount), 2) AS receita_media_usd,
       ROUND(SUM(total_amount), 2) AS receita_total_usd FROM {src} GROUP BY trip_month"""

KPI_OF = """SELECT trip_month, COUNT(*) AS qtd_corridas, ROUND(AVG(total_amount), 2) AS receita_media_usd,
       CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS linhas FROM {src} GROUP BY trip_month"""

_RAW_LANDING = """
  SELECT CAST(l_suppkey AS BIGINT) AS VendorID,
         NULLIF(l_quantity - 1, 13) AS passenger_count,
         l_extendedprice - 2000 AS total_amount,
         o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS tpep_pickup_datetime,
         l_shipdate AS tpep_dropoff_datetime,
         l_quantity AS trip_distance,
         l_returnflag AS store_and_fwd_flag,
         CAST(l_linenumber AS DOUBLE) AS RatecodeID,
         l_partkey AS PULocationID,
         l_suppkey AS DOLocationID,
         CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type,
         l_tax AS airport_fee,
         l_discount AS congestion_surcharge,
         CAST(l_linenumber AS BIGINT) AS nanos_part
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

LANDING = f"""landing_rows AS ({_RAW_LANDING}
  UNION ALL{_RAW_LANDING}
  WHERE l_orderkey % 50 = 0),
landing AS (
  SELECT VendorID, passenger_count, total_amount, tpep_pickup_datetime, tpep_dropoff_datetime,
         trip_distance, store_and_fwd_flag, RatecodeID, PULocationID, DOLocationID, payment_type,
         airport_fee,
         CASE WHEN month(tpep_pickup_datetime) % 2 = 0 THEN congestion_surcharge END
           AS congestion_surcharge,
         strftime(tpep_pickup_datetime, '%Y-%m') AS _source_month,
         nanos_part
  FROM landing_rows)"""

LANDING_COLS = ("VendorID, passenger_count, total_amount, tpep_pickup_datetime, "
                "tpep_dropoff_datetime, trip_distance, store_and_fwd_flag, RatecodeID, "
                "PULocationID, DOLocationID, payment_type, airport_fee, congestion_surcharge")

KPI_DOCUMENT = """
SELECT CAST(to_json({
  'meta': {
    'linhas_silver': (SELECT COUNT(*) FROM silver),
    'periodo': (SELECT min(strftime(tpep_pickup_datetime, '%Y-%m')) || ' a '
                       || max(strftime(tpep_pickup_datetime, '%Y-%m')) FROM silver),
    'nota': 'KPIs computed by farebox over the Silver layer.',
    'linhas_landing': (SELECT COUNT(*) FROM trips_raw),
    'taxa_descartada_pct': (SELECT ROUND(((SELECT COUNT(*) FROM trips_raw) - COUNT(*)) * 100.0::DOUBLE
                                         / (SELECT COUNT(*) FROM trips_raw), 2) FROM silver)},
  'q1_receita_mensal': (SELECT list({'mes_num': trip_month, 'mes': """ + MONTH_LABEL_SQL.format(
    m="trip_month") + """,
                                     'corridas': qtd_corridas,
                                     'receita_media_usd': receita_media_usd} ORDER BY trip_month)
                        FROM q1),
  'q1_media_global_usd': (SELECT ROUND(AVG(total_amount), 2) FROM silver),
  'q2_passageiros_hora_maio': (SELECT list({'hora': pickup_hour, 'corridas': qtd_corridas,
                                            'media_passageiros': media_passageiros}
                                           ORDER BY pickup_hour) FROM q2)
}) AS VARCHAR) AS document"""


def newest_of(*changes: str) -> str:
    """Cleaned trips where every raw row arrives once per change of its amount; the last clean arrival of a key wins."""
    arms = "\n  UNION ALL ".join(f"""SELECT *, {i} AS arrived FROM (SELECT DISTINCT * REPLACE (total_amount + {c} AS total_amount)
    FROM not_null)""" for i, c in enumerate(changes))
    return with_("not_null", extra=[f"arrivals AS (\n  {arms})", f"""cleaned AS (
  SELECT *, CAST(month(tpep_pickup_datetime) AS INTEGER) AS trip_month, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour
  FROM arrivals
  WHERE total_amount > 0 AND passenger_count > 0 AND tpep_dropoff_datetime > tpep_pickup_datetime
    AND tpep_pickup_datetime >= TIMESTAMP '{WINDOW_START}' AND tpep_pickup_datetime < TIMESTAMP '{WINDOW_END}')"""]) + """
SELECT * EXCLUDE (rn, arrived) FROM (SELECT *, row_number() OVER (
  PARTITION BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime
  ORDER BY arrived DESC, total_amount DESC, passenger_count DESC) AS rn FROM cleaned) WHERE rn = 1"""


def more_sql() -> dict[str, str]:
    typed_metrics = with_("typed", extra=[METRICS.format(src="typed")])
    silver_metrics = with_("silver", extra=[METRICS.format(src="silver")])
    scen = with_("silver", extra=SCENARIO)
    merges = with_("silver", extra=SCENARIO + THREE_MERGES)
    return {
        # quality
        "dq_metrics": typed_metrics + "SELECT * FROM metrics",
        "dq_report": typed_metrics + REPORT,
        "dq_report_silver": silver_metrics + REPORT,
        "dq_custom": with_("silver") + """
SELECT 'colunas_obrigatorias_presentes' AS "check", CAST(0 AS BIGINT) AS metric, TRUE AS passed,
       TRUE AS critical, 'ok' AS detail
UNION ALL SELECT 'hora_valida', COUNT(*) FILTER (WHERE pickup_hour NOT BETWEEN 0 AND 23),
       COUNT(*) FILTER (WHERE pickup_hour NOT BETWEEN 0 AND 23) = 0, TRUE,
       CAST(COUNT(*) FILTER (WHERE pickup_hour NOT BETWEEN 0 AND 23) AS VARCHAR)
         || ' horas fora de 0-23' FROM silver
UNION ALL SELECT 'vendor_positivo', COUNT(*) FILTER (WHERE VendorID <= 0),
       COUNT(*) FILTER (WHERE VendorID <= 0) = 0, TRUE,
       CAST(COUNT(*) FILTER (WHERE VendorID <= 0) AS VARCHAR) || ' vendors <= 0' FROM silver
UNION ALL SELECT 'valor_ate_100k', COUNT(*) FILTER (WHERE total_amount > 100000),
       COUNT(*) FILTER (WHERE total_amount > 100000) = 0, FALSE,
       CAST(COUNT(*) FILTER (WHERE total_amount > 100000) AS VARCHAR) || ' linhas > 100000'
FROM silver""",
        "discard_rate": with_("typed", extra=[f"""ruled AS (
  SELECT *, CASE
    WHEN VendorID IS NULL OR passenger_count IS NULL OR total_amount IS NULL
         OR isnan(total_amount) OR tpep_pickup_datetime IS NULL
         OR tpep_dropoff_datetime IS NULL THEN 'nulos'
    WHEN total_amount <= 0 THEN 'valor'
    WHEN passenger_count <= 0 THEN 'passageiros'
    WHEN tpep_dropoff_datetime <= tpep_pickup_datetime THEN 'cronologia'
    WHEN NOT (tpep_pickup_datetime >= TIMESTAMP '{WINDOW_START}'
              AND tpep_pickup_datetime < TIMESTAMP '{WINDOW_END}') THEN 'janela'
    ELSE 'mantida' END AS rule
  FROM typed)""", """counts AS (
  SELECT COUNT(*) AS landing,
         (SELECT COUNT(*) FROM (SELECT DISTINCT VendorID, passenger_count, total_amount,
                 tpep_pickup_datetime, tpep_dropoff_datetime FROM ruled WHERE rule = 'mantida'))
           AS silver,
         COUNT(*) FILTER (WHERE rule = 'mantida') AS kept,
         COUNT(*) FILTER (WHERE rule = 'nulos') AS nulos,
         COUNT(*) FILTER (WHERE rule = 'valor') AS valor,
         COUNT(*) FILTER (WHERE rule = 'passageiros') AS passageiros,
         COUNT(*) FILTER (WHERE rule = 'cronologia') AS cronologia,
         COUNT(*) FILTER (WHERE rule = 'janela') AS janela
  FROM ruled)"""]) + """
SELECT landing AS linhas_landing, silver AS linhas_silver,
       ROUND(CAST(landing - silver AS DOUBLE) * 100.0 / landing, 2) AS taxa_descartada_pct,
       nulos AS descartadas_nulos, valor AS descartadas_valor,
       passageiros AS descartadas_passageiros, cronologia AS descartadas_cronologia,
       janela AS descartadas_janela, kept - silver AS descartadas_duplicadas
FROM counts""",
        "unique_key_violations": """
SELECT CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicated_keys,
       CAST(COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
        "dedup_natural_key": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC, l_shipdate DESC) AS rn
      FROM lineitem)
WHERE rn = 1""",
        # incremental
        "merge_upsert": scen + "SELECT * FROM upserted",
        "merge_metrics": scen + f"""
SELECT COUNT(*) FILTER (WHERE t.VendorID IS NULL) AS inserted,
       COUNT(*) FILTER (WHERE t.VendorID IS NOT NULL) AS updated,
       CAST(0 AS BIGINT) AS deleted, COUNT(*) AS source_rows
FROM source s LEFT JOIN (SELECT DISTINCT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
                                trip_month FROM target) t
  ON {KEY_MATCH.format(a='s', b='t')}""",
        "change_set": scen + CHANGE_SET,
        "merge_history_metrics": scen + f"""
SELECT COUNT(*) FILTER (WHERE t.VendorID IS NULL) AS inserted,
       COUNT(*) FILTER (WHERE t.VendorID IS NOT NULL) AS updated,
       CAST(0 AS BIGINT) AS deleted, COUNT(*) AS source_rows
FROM source s LEFT JOIN target t ON {KEY_MATCH.format(a='s', b='t')}""",
        "change_feed": merges + CHANGE_FEED,
        "change_replay": merges + "SELECT * FROM v2",
        "gold_incremental": merges + Q1_OF.format(src="v2"),
        "incremental_since_watermark": with_("trips_raw") + """
SELECT *, tpep_dropoff_datetime + INTERVAL 1 HOUR AS _ingested_at FROM trips_raw
WHERE tpep_dropoff_datetime + INTERVAL 1 HOUR > (
  SELECT max(tpep_dropoff_datetime + INTERVAL 1 HOUR) FROM trips_raw
  WHERE tpep_dropoff_datetime + INTERVAL 1 HOUR <= TIMESTAMP '1997-03-01')""",
        "incremental_silver": newest_of("-250.0", "125.0", "0.0"),
        "merge_partition_scoped": scen + f""",
late AS (SELECT * FROM source WHERE trip_month >= 4)
SELECT * FROM target WHERE trip_month < 4
UNION ALL SELECT * FROM late
UNION ALL SELECT * FROM target t WHERE trip_month >= 4
  AND NOT EXISTS (SELECT 1 FROM late s WHERE {KEY_MATCH.format(a='s', b='t')})""",
        "merge_idempotent": scen + "SELECT * FROM upserted",
        # snapshots
        "read_as_of_version": scen + "SELECT * FROM target",
        "read_as_of_timestamp": scen + "SELECT * FROM target",
        "restore_version": scen + "SELECT * FROM target",
        "kpi_diff": scen + f""",
ka AS ({KPI_OF.format(src='target')}),
kb AS ({KPI_OF.format(src='upserted')})
SELECT COALESCE(a.trip_month, b.trip_month) AS trip_month,
       a.qtd_corridas AS qtd_corridas_a, b.qtd_corridas AS qtd_corridas_b,
       a.receita_media_usd AS receita_media_usd_a, b.receita_media_usd AS receita_media_usd_b,
       a.linhas AS linhas_a, b.linhas AS linhas_b,
       ROUND(b.qtd_corridas - a.qtd_corridas, 2) AS qtd_corridas_delta,
       ROUND(b.receita_media_usd - a.receita_media_usd, 2) AS receita_media_usd_delta,
       ROUND(b.linhas - a.linhas, 2) AS linhas_delta
FROM ka a FULL OUTER JOIN kb b ON a.trip_month = b.trip_month""",
        "snapshot_as_of_timestamp": scen + "SELECT * FROM target",
        "history_latest": merges + """
SELECT 1 AS version, 'MERGE' AS operation, TRUE AS has_user, TRUE AS in_order,
       COUNT(*) FILTER (WHERE VendorID % 3 = 2) AS inserted, COUNT(*) FILTER (WHERE VendorID % 3 = 1) AS updated,
       CAST(0 AS BIGINT) AS deleted, COUNT(*) FILTER (WHERE VendorID % 3 = 1) AS changed,
       CAST(0 AS BIGINT) AS stale, COUNT(*) AS source_rows FROM late
UNION ALL
SELECT 2, 'MERGE', TRUE, TRUE, 0, COUNT(*) FILTER (WHERE NOT gone), COUNT(*) FILTER (WHERE gone),
       COUNT(*) FILTER (WHERE NOT gone), 0, COUNT(*) FROM back""",
        "history_document": merges + """
SELECT 0 AS version, 'WRITE' AS operation, COUNT(*) AS source_rows, CAST(0 AS BIGINT) AS changed, TRUE AS same_time FROM target
UNION ALL SELECT 1, 'MERGE', COUNT(*), COUNT(*) FILTER (WHERE VendorID % 3 = 1), TRUE FROM late
UNION ALL SELECT 2, 'MERGE', COUNT(*), COUNT(*) FILTER (WHERE NOT gone), TRUE FROM back""",
        "kpi_diff_document": scen + f""",
ka AS ({KPI_OF.format(src='target')}),
kb AS ({KPI_OF.format(src='upserted')})
SELECT CAST(to_json({{'meses': list({{
         'trip_month': a.trip_month,
         'qtd_corridas_a': a.qtd_corridas, 'qtd_corridas_b': b.qtd_corridas,
         'receita_media_usd_a': a.receita_media_usd, 'receita_media_usd_b': b.receita_media_usd,
         'linhas_a': a.linhas, 'linhas_b': b.linhas,
         'qtd_corridas_delta': b.qtd_corridas - a.qtd_corridas,
         'receita_media_usd_delta': ROUND(b.receita_media_usd - a.receita_media_usd, 2),
         'linhas_delta': b.linhas - a.linhas}} ORDER BY a.trip_month)}}) AS VARCHAR) AS document
FROM ka a JOIN kb b ON a.trip_month = b.trip_month""",
        # sinks and catalog
        "catalog_register_all": """
SELECT * FROM (VALUES ('bronze_trips', 'missing'), ('silver_trips', 'registered'),
  ('gold_receita_mensal', 'registered'), ('gold_passageiros_hora_maio', 'registered'),
  ('gold_trips', 'registered')) AS t(name, status)""",
        "catalog_show": """
SELECT 'farebox' AS database, name FROM (VALUES ('bronze_trips'), ('silver_trips'), ('gold_receita_mensal'),
  ('gold_passageiros_hora_maio'), ('gold_trips')) AS t(name)""",
        "catalog_describe": """
SELECT * FROM (VALUES ('VendorID', 'int'), ('passenger_count', 'int'), ('total_amount', 'double'),
  ('tpep_pickup_datetime', 'timestamp_ntz'), ('tpep_dropoff_datetime', 'timestamp_ntz'),
  ('trip_month', 'int'), ('pickup_hour', 'int')) AS t(col_name, data_type)""",
        "quantiles_approx": """
SELECT TRUE AS p50_within, TRUE AS p90_within, TRUE AS p99_within, TRUE AS p999_within""",
        "quantiles_stored_sketches": """
SELECT TRUE AS p50_within, TRUE AS p90_within, TRUE AS p99_within, TRUE AS p999_within""",
        "tail_distortion_sketches": with_("silver") + """
SELECT trip_month AS mes, ROUND(AVG(total_amount), 2) AS media, TRUE AS median_within FROM silver GROUP BY trip_month""",
        "silver_write": with_("silver") + "SELECT * FROM silver",
        "silver_write_path": with_("silver") + "SELECT * FROM silver",
        "catalog_drop_keeps_data": with_("silver") + "SELECT * FROM silver",
        "silver_head": with_("silver") + """
SELECT * FROM silver
ORDER BY tpep_pickup_datetime, tpep_dropoff_datetime, VendorID, total_amount, passenger_count LIMIT 20""",
        "gate_refuses": with_("silver", extra=[METRICS.format(src="typed")]) + """
SELECT concat_ws(',', CASE WHEN dropoff_not_after > 0 THEN 'dropoff_apos_pickup' END,
                 CASE WHEN passengers_not_positive > 0 THEN 'passenger_count_positivo' END,
                 CASE WHEN missing_VendorID + missing_passenger_count + missing_total_amount + missing_tpep_pickup_datetime
                           + missing_tpep_dropoff_datetime > 0 THEN 'sem_nulos_em_obrigatorias' END,
                 CASE WHEN amount_not_positive > 0 THEN 'total_amount_positivo' END) AS refused,
       (SELECT COUNT(*) FROM silver) AS linhas FROM metrics""",
        "gold_write_aggregates": with_("q1") + "SELECT * FROM q1",
        "gold_trips": with_("silver") + """
SELECT VendorID, passenger_count, total_amount, tpep_pickup_datetime, tpep_dropoff_datetime,
       trip_month FROM silver""",
        "bronze_backfill_month": "WITH " + LANDING + f"""
SELECT {LANDING_COLS.replace('total_amount,', "CASE WHEN _source_month = '1997-03' THEN total_amount + 1 ELSE total_amount END AS total_amount,")},
       _source_month
FROM landing""",
        "catalog_register": with_("silver") + "SELECT * FROM silver",
        "layers_end_to_end": with_("q1") + "SELECT * FROM q1",
        "catalog_sql_hourly": with_("silver") + """
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hora_do_dia, COUNT(*) AS qtd_corridas,
       ROUND(AVG(passenger_count), 3) AS media_passageiros
FROM silver WHERE trip_month = 5 GROUP BY 1""",
        "catalog_sql_scan": with_("q1") + """
SELECT trip_month AS mes, qtd_corridas, receita_media_usd, receita_total_usd FROM q1""",
        # landing
        "landing_scan": f"WITH {LANDING}\nSELECT {LANDING_COLS}, _source_month FROM landing",
        "landing_normalise_types": f"""WITH {LANDING}
SELECT VendorID, passenger_count, total_amount,
       CASE WHEN odd THEN CAST(epoch_us(tpep_pickup_datetime) * 1000 + nanos_part AS VARCHAR)
            ELSE strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') END AS tpep_pickup_datetime,
       CASE WHEN odd THEN CAST(epoch_us(tpep_dropoff_datetime) * 1000 + nanos_part AS VARCHAR)
            ELSE strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') END AS tpep_dropoff_datetime,
       trip_distance, store_and_fwd_flag, RatecodeID, PULocationID, DOLocationID, payment_type,
       airport_fee, congestion_surcharge,
       CASE WHEN odd THEN 'bigint' ELSE 'timestamp_ntz' END AS stored_as
FROM (SELECT *, month(tpep_pickup_datetime) % 2 = 1 AS odd FROM landing)""",
        "landing_union_by_name": f"WITH {LANDING}\nSELECT {LANDING_COLS} FROM landing",
        "nanos_to_timestamp": f"""WITH {LANDING}
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime FROM landing""",
        "bronze_lineage": f"""WITH {LANDING}
SELECT 'yellow_tripdata_' || _source_month || '.parquet' AS file, _source_month, COUNT(*) AS linhas,
       COUNT(*) AS com_carga FROM landing GROUP BY _source_month""",
        "bronze_source_month": f"""WITH {LANDING}
SELECT _source_month, COUNT(*) AS linhas FROM landing GROUP BY _source_month""",
        # documents
        "kpi_document": with_("q1", "q2") + KPI_DOCUMENT,
        "kpi_json_roundtrip": with_("q1") + f"""
SELECT trip_month AS mes_num, {MONTH_LABEL_SQL.format(m='trip_month')} AS mes,
       qtd_corridas AS corridas, receita_media_usd FROM q1""",
        # streaming
        "stream_landing_to_bronze": f"WITH {LANDING}\nSELECT {LANDING_COLS}, _source_month FROM landing",
        "stream_upsert": newest_of("0.0", "CASE WHEN month(tpep_pickup_datetime) % 2 = 1 THEN 125.0 ELSE -250.0 END"),
    }
