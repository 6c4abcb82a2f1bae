from __future__ import annotations

from farebox.operators import aggregates as agg
from farebox.operators.cleaning import to_silver


def test_revenue_by_month(raw_df):
    rows = agg.monthly_revenue(to_silver(raw_df)).collect()
    assert [(r.trip_month, r.qtd_corridas, r.receita_media_usd, r.receita_total_usd) for r in rows] == [
        (2, 1, 12.75, 12.75), (3, 1, 31.5, 31.5), (4, 1, 8.0, 8.0)]


def test_passengers_by_hour_of_one_month(raw_df):
    s = to_silver(raw_df)
    hours = {m: [(r.pickup_hour, r.media_passageiros) for r in agg.hourly_passengers(s, month=m).collect()]
             for m in (1, 2, 4)}
    assert hours == {1: [], 2: [(23, 3.0)], 4: [(21, 5.0)]}


def test_sql_equals_api(spark, raw_df):
    s = to_silver(raw_df)
    eq = agg.bag_equality(agg.monthly_revenue(s), agg.monthly_revenue_sql(spark, s, "t_eq")).first()
    assert eq.equal and eq.left_rows == 3


def test_bag_equality_counts_copies_and_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, "z")], "p int, q string")
    r = agg.bag_equality(a, b).first()
    assert (r.left_rows, r.right_rows, r.only_left, r.only_right, r.equal) == (4, 4, 2, 2, False)
    empty = agg.bag_equality(a.limit(0), b.limit(0)).first()
    assert empty.equal and empty.left_rows == 0


def test_derived_kpis(spark):
    q1 = spark.createDataFrame(
        [(1, 10, 27.46), (2, 10, 27.37), (3, 10, 29.45), (4, 10, 29.45)],
        "trip_month int, qtd_corridas bigint, receita_media_usd double")
    peak = agg.peak_month(q1).first()
    assert (peak.mes_num, peak.mes) == (3, "Mar")  # first month on ties
    growth = agg.growth_first_last(q1).first()
    assert growth.crescimento_pct == round((29.45 / 27.46 - 1) * 100, 1)
    q2 = spark.createDataFrame([(0, 10, 1.5), (1, 30, 1.2), (2, 20, 1.5)],
                               "pickup_hour int, qtd_corridas bigint, media_passageiros double")
    pl = agg.peak_low_hour(q2).first()
    assert (pl.hora_pico, pl.hora_minima) == (0, 1)
    w = agg.weighted_passengers(q2).first()[0]
    assert abs(w - (1.5 * 10 + 1.2 * 30 + 1.5 * 20) / 60) < 1e-4
    inten = {r.pickup_hour: r.intensidade for r in agg.demand_intensity(q2).collect()}
    assert inten == {0: round(10 / 30, 4), 1: 1.0, 2: round(20 / 30, 4)}


def test_quantiles_approx_rank_error(spark):
    n = 20000
    df = spark.range(n).selectExpr("CAST(id AS DOUBLE) AS total_amount")
    row = agg.quantiles_approx(df, relative_error=0.001).first()
    for p, name in zip(agg.QUANTILE_PROBS, agg.QUANTILE_NAMES):
        assert abs(row[name] - p * n) <= 0.001 * n + 1


def test_kpi_document_json_roundtrip_through_from_json(spark, raw_df):
    from farebox.operators import documents as docs

    text = docs.to_json_document(docs.kpi_document(to_silver(raw_df)))
    rows = docs.monthly_rows(docs.parse_kpi_json(text)).collect()
    assert [(r.mes_num, r.mes, r.corridas, r.receita_media_usd) for r in rows] == [
        (2, "Fev", 1, 12.75), (3, "Mar", 1, 31.5), (4, "Abr", 1, 8.0)]


def test_kpi_document_meta_with_discard_rate(spark, raw_df):
    from farebox.operators import documents as docs

    doc = docs.kpi_document(to_silver(raw_df), landing=raw_df).first()
    assert (doc.meta.linhas_silver, doc.meta.linhas_landing) == (3, 9)
    assert doc.meta.taxa_descartada_pct == round(6 * 100 / 9, 2)
    plain = docs.kpi_document(to_silver(raw_df)).first()
    assert "linhas_landing" not in plain.meta.asDict()
