import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymart.operators.forecasting import average_forecast, fitted_trend, fitted_trend_forecast, holt_forecast
from quaymart.operators.scopes import forecast_scope, new_tickets, scope_filter, tag_windows, vendors_by_category
from quaymart.params import MartParams
from quaymart.plans import forecast, outbound
from tests.conftest import rows_of
from tests.test_marts import COMMON, move, tables  # noqa: F401

AS_OF = dt.date(2024, 6, 15)
P = MartParams(as_of=AS_OF, alert_email="a@b.c", helpdesk_team_id=3)


def holt_by_hand(qtys):
    best = None
    for a in range(1, 10):
        for b in range(1, 10):
            level, trend, sse = qtys[0], qtys[1] - qtys[0], 0.0
            for qty in qtys[1:]:
                expected = level + trend
                new = a / 10 * qty + (1 - a / 10) * expected
                trend = b / 10 * (new - level) + (1 - b / 10) * trend
                level, sse = new, sse + (qty - expected) ** 2
            fit = (round(sse, 6), a, b, level + trend)
            best = fit if best is None or fit[:3] < best[:3] else best
    return best[3]


def test_forecast_kernels(frame):
    series = [[4.0], [1.0, 2.0, 6.0], [3.0, 9.0, 1.0, 7.0, 2.0], [5.0] * 6, [1.0, 2.0, 3.0, 4.0], [9.0, 7.5, 8.0, 2.0, 3.5, 1.0]]
    df = frame("i int, qtys array<double>", enumerate(series))
    got = df.select("i", average_forecast(F.col("qtys")).alias("a"), holt_forecast(F.col("qtys")).alias("h"))
    for i, average, holt in rows_of(got):
        qtys = series[i]
        assert average == pytest.approx(sum(qtys[-3:]) / len(qtys[-3:]))
        assert holt == (pytest.approx(holt_by_hand(qtys)) if len(qtys) >= 4 else None)


def errors_by_hand(qtys, a, b, level, trend):
    errors = []
    for qty in qtys:
        expected = level + trend
        errors.append(qty - expected)
        new = a * qty + (1 - a) * expected
        level, trend = new, b * (new - level) + (1 - b) * trend
    return np.array(errors), level + trend


def trend_by_hand(qtys, a, b):
    """(squared error, forecast) with the best start state, from a general solver."""
    base = errors_by_hand(qtys, a, b, 0.0, 0.0)[0]
    slopes = np.stack([errors_by_hand([0.0] * len(qtys), a, b, *s)[0] for s in ((1.0, 0.0), (0.0, 1.0))], axis=1)
    errors, forecast = errors_by_hand(qtys, a, b, *np.linalg.lstsq(slopes, -base, rcond=None)[0])
    return float(errors @ errors), forecast


def test_fitted_trend_is_the_least_squares_of_its_factors_and_no_worse_than_the_grid(frame):
    draw = np.random.default_rng(4)
    series = [[1.0, 2.0], [5.0] * 6, [2.0, 4.0, 6.0, 8.0], [0.0] * 5, [-3.0, 1e6, 2.0, 5.0, 7.0]]
    series += [[float(x) for x in draw.integers(0, 90, int(draw.integers(4, 14)))] for _ in range(25)]
    df = frame("i int, qtys array<double>", enumerate(series))
    got = df.select("i", fitted_trend_forecast(F.col("qtys")).alias("f"), fitted_trend(F.col("qtys")).alias("fit"))
    for i, forecast, fit in rows_of(got):
        qtys = series[i]
        if len(qtys) < 4:
            assert forecast is None
            continue
        top, tenths = max(map(abs, qtys)) or 1.0, [k / 10 for k in range(1, 10)]
        share, by_hand = trend_by_hand([q / top for q in qtys], fit["alpha"] / 160, fit["beta"] / 160)
        assert fit["sse"] == pytest.approx(share, abs=1e-8) and forecast == pytest.approx(by_hand * top, rel=1e-6, abs=1e-6)
        assert fit["sse"] <= min(trend_by_hand([q / top for q in qtys], a, b)[0] for a in tenths for b in tenths) + 1e-8
        first = [errors_by_hand(qtys, a, b, 2 * qtys[0] - qtys[1], qtys[1] - qtys[0])[0] for a in tenths for b in tenths]
        assert fit["sse"] <= min(float(e @ e) for e in first) / top**2 + 1e-8  # the grid's start state
    straight = {i: f for i, f, _ in rows_of(got)}
    assert straight[1] == pytest.approx(5.0) and straight[2] == pytest.approx(10.0) and straight[3] == 0.0


def test_forecast_uses_the_points_there_are_and_the_month_after_the_last(tables):  # noqa: F811
    def on(i, month, qty, product=1):
        return move(i, product=product, qty=qty, when=dt.datetime(2024 if month < 7 else 2023, month, 20 if month < 6 else 1))
    moves = [on(1, 1, 3.0), on(2, 1, 3.0), on(3, 3, 9.0), on(4, 4, 12.0), on(5, 12, 99.0), on(6, 2, 8.0, product=2)]
    t = tables(stock_move=moves, **COMMON)
    scope = MartParams(as_of=AS_OF, forecast_scope="all")
    assert [(r[0], r[1], round(r[2], 6), round(r[3], 6)) for r in rows_of(
        forecast.demand_forecast(t, scope), "product_id", "forecast_month", "forecast_qty", "lower_ci")] == [
        (1, dt.date(2024, 5, 1), 9.0, 7.65), (2, dt.date(2024, 3, 1), 8.0, 6.8)]


def test_scopes_and_the_empty_scope(frame):
    abc = frame("company_id bigint, product_id bigint, total_value_moved double, abc_class string",
                [(1, 1, 5.0, "A"), (1, 2, 9.0, "B"), (2, 1, 5.0, "C")])
    series = abc.select("company_id", "product_id")
    kept = lambda scope: rows_of(scope_filter(series, forecast_scope(abc, scope)))
    assert kept("only_class_a") == [(1, 1)]
    assert kept("top_n:2") == [(1, 1), (1, 2)]
    for everything in ("top_n:0", "top_n:x", "all"):
        assert len(kept(everything)) == 3
    none = forecast_scope(abc.where("abc_class = 'B'"), "only_class_a")
    assert scope_filter(series, none).count() == 3


def test_alert(frame):
    rating = frame("month date, overall_score double", [(dt.date(2024, 6, 1), 0.7), (dt.date(2024, 5, 1), 0.1)])
    alert = lambda df, p: outbound.otif_alert(df, p).collect()[0].alert
    assert alert(rating, P) is True
    assert alert(rating, MartParams(as_of=AS_OF)) is False
    assert alert(rating.where("overall_score < 0.5"), P) is False
    assert alert(rating, MartParams(as_of=AS_OF, alert_email="a@b.c", otif_threshold=0.7)) is False


def test_tickets_are_one_per_product_and_day(frame):
    anomalies = frame("snapshot_date date, company_id bigint, product_id bigint, deviation_pct double", [
        (AS_OF, 2, 7, 0.5), (AS_OF, 1, 7, -0.25), (AS_OF, 1, 8, 1.0), (AS_OF, 1, 9, 0.333333), (dt.date(2024, 6, 14), 1, 5, 1.0)])
    existing = frame("name string, create_date timestamp_ntz", [
        ("COGS anomaly product 8", dt.datetime(2024, 6, 15)), ("COGS anomaly product 9", dt.datetime(2024, 6, 14, 23))])
    assert rows_of(outbound.anomaly_tickets(anomalies, existing, P)) == [
        ("COGS anomaly product 7", "Check item 7. Cost deviated -25.00% from 30-day average.", 3),
        ("COGS anomaly product 9", "Check item 9. Cost deviated 33.33% from 30-day average.", 3)]
    assert outbound.anomaly_tickets(anomalies, existing, MartParams(as_of=AS_OF)).count() == 0
    assert new_tickets(existing.select("name"), existing, AS_OF).count() == 1


def test_writeback_takes_the_best_class_of_a_template(frame):
    abc = frame("snapshot_date date, company_id bigint, product_id bigint, abc_class string", [
        (AS_OF, 1, 1, "C"), (AS_OF, 2, 2, "B"), (AS_OF, 1, 3, "A"), (AS_OF, 1, 4, "A"), (dt.date(2024, 6, 1), 1, 1, "A")])
    products = frame("id bigint, company_id bigint, product_tmpl_id bigint", [(1, 0, 10), (1, 2, 10), (2, 0, 10), (3, 0, 0)])
    assert rows_of(outbound.abc_writeback(abc, products, P)) == [(10, "B")]


def test_windows(frame):
    day = lambda n: dt.date(2024, 1, n)
    windows = frame("kind string, company string, date date, end_date date", [
        ("STOCKOUT", "a", day(2), day(4)), ("STOCKOUT", "a", day(3), day(3)), ("SUPPLIER_DELAY", "a", day(4), day(5)),
        ("SHRINKAGE", "a", day(5), None), ("STOCKOUT", "a", day(7), None), ("SUPPLIER_DELAY", "b", day(9), day(8))])
    rows = frame("company string, date date", [("a", day(n)) for n in range(1, 9)] + [("b", day(n)) for n in (3, 8, 9)])
    hits = tag_windows(rows, windows)
    assert rows_of(hits.where("is_stockout"), "date") == [(day(n),) for n in (2, 3, 4)]
    assert rows_of(hits.where("delay_add = 15"), "date") == [(day(n),) for n in (4, 5)]
    assert rows_of(hits.where("is_shrinkage"), "date") == [(day(5),)]
    assert hits.count() == 11


def test_vendors_by_category_keeps_empty_categories(frame):
    links = frame("partner_id bigint, product_tmpl_id bigint, company_id bigint",
                  [(9, 1, 0), (9, 2, 5), (3, 1, 5), (4, 1, 6), (3, 1, None), (0, 1, 0), (8, 7, 0)])
    products = frame("product_tmpl_id bigint, product_id bigint, category string",
                     [(1, 1, "Seeds"), (2, 2, "Seeds"), (3, 3, "Tools"), (0, 4, "Tools")])
    categories = frame("category string", [("Seeds",), ("Tools",), ("Other",)])
    assert rows_of(vendors_by_category(links, products, categories, 5)) == [
        ("Other", []), ("Seeds", [3, 9]), ("Tools", [])]
