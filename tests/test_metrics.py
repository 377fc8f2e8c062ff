import random
from datetime import timedelta

import pytest
from conftest import tuples, utc
from tidewatch.operators import metrics

T0 = utc(2026, 5, 5)
SCHEMA = "ts timestamp, metric string, labels map<string, string>, value double"


def samples(spark, rows):
    return spark.createDataFrame([(T0 + timedelta(seconds=s), m, labels, float(v)) for s, m, labels, v in rows], SCHEMA)


def test_increase_with_reset_and_first_sample(spark):
    frame = samples(spark, [(0, "c", {}, 5), (15, "c", {}, 8), (30, "c", {}, 2), (45, "c", {}, 4)])
    assert metrics.increases(frame, 3600).first().increase == 3 + 2 + 2


def test_rate_sums_series_and_groups_by_label(spark):
    rows = [(0, "e", {"operation": "a", "x": "1"}, 0), (60, "e", {"operation": "a", "x": "1"}, 6),
            (0, "e", {"x": "2", "operation": "a"}, 0), (60, "e", {"operation": "a", "x": "2"}, 3),
            (0, "e", {"operation": "b"}, 1), (60, "e", {"operation": "b"}, 1), (60, "other", {}, 99)]
    got = {row.operation: row.rate for row in metrics.rate(samples(spark, rows), "e", 90, ("operation",)).collect()}
    assert got == {"a": 9 / 90, "b": 0.0}


def test_server_errors_only(spark):
    rows = [(s, "r", {"status": status}, s) for s in (0, 10) for status in ("200", "500", "503", "5000")]
    got = metrics.rate(samples(spark, rows), "r", 10, ("status",), metrics.server_errors())
    assert {row.status for row in got.collect()} == {"500", "503"}


def test_increases_over_windows_match_one_long_lag(spark):
    rng = random.Random(5)
    rows, value = [], {"a": 0, "b": 0}
    for second in range(0, 20000, 137):
        for series in value:
            value[series] = 0 if rng.random() < 0.05 else value[series] + rng.randrange(5)
            if rng.random() < 0.8:
                rows.append((second, "c", {"s": series}, value[series]))
    want, last = {}, {}
    for second, _, labels, v in rows:
        previous = last.get(labels["s"])
        delta = 0 if previous is None else (v if v < previous else v - previous)
        key = (labels["s"], second // 900)
        want[key] = want.get(key, 0) + delta
        last[labels["s"]] = v
    rng.shuffle(rows)
    got = {
        (row.labels["s"], int(row.window_start.timestamp() - T0.timestamp()) // 900): row.increase
        for row in metrics.increases(samples(spark, rows), 900).collect()
    }
    assert got == want


def test_increase_since_uses_the_last_value_before(spark):
    rows = [(0, "c", {}, 10), (100, "c", {}, 20), (1000, "c", {}, 25), (1100, "c", {}, 3), (5000, "c", {}, 999)]
    frame = samples(spark, rows)
    as_of = T0 + timedelta(seconds=1200)
    assert metrics.increase_since(frame, "c", as_of, 15).first().increase == 5 + 3
    assert metrics.increase_since(frame, "none", as_of, 15).first().increase == 0


def test_latest_and_total(spark):
    frame = samples(spark, [(0, "g", {"p": "0"}, 5), (15, "g", {"p": "0"}, 2), (0, "g", {"p": "1"}, 4)])
    assert {row.labels["p"]: row.value for row in metrics.latest(frame, "g").collect()} == {"0": 2.0, "1": 4.0}
    assert tuples(metrics.total(frame, "g")) == [("g", 6.0)]


def test_histogram_is_cumulative(spark):
    frame = spark.createDataFrame([(0.005,), (0.03,), (20.0,), (None,)], "d double")
    got = {row.le: row["count"] for row in metrics.histogram(frame, "d").collect()}
    assert got == {"0.005": 1, "0.01": 1, "0.025": 1, "0.05": 2, "0.1": 2, "0.25": 2, "0.5": 2, "1": 2, "2.5": 2, "5": 2, "10": 2, "+Inf": 3}


def quantile(spark, counts, q):
    frame = spark.createDataFrame(list(counts.items()), "le string, count long")
    row = metrics.histogram_quantile(frame, q).first()
    return row and row.quantile


def test_quantile_interpolates(spark):
    assert quantile(spark, {"1": 10, "2": 20, "+Inf": 20}, 0.75) == 1.5
    assert quantile(spark, {"1": 10, "2": 10, "+Inf": 10}, 0.5) == 0.5


def test_quantile_above_the_last_bound_and_without_observations(spark):
    assert quantile(spark, {"1": 1, "2": 2, "+Inf": 100}, 0.95) == 2.0
    assert quantile(spark, {"1": 0, "+Inf": 0}, 0.95) is None


def test_request_summary(spark):
    rows = [("GET", "/a", "200", 0.02)] * 3 + [("GET", "/a", "500", 0.2)]
    frame = spark.createDataFrame(rows, "method string, path string, status string, duration double")
    got = {row.status: (row.requests, row.p95_seconds) for row in metrics.request_summary(frame).collect()}
    assert got["200"][0] == 3 and got["500"][0] == 1
    assert got["200"][1] == pytest.approx(0.01 + 0.015 * 0.95)


def test_quantile_of_rates(spark):
    rows = []
    for second, (low, high) in ((0, (0, 0)), (30, (8, 10))):
        rows += [(second, "d_bucket", {"le": "1", "op": "x"}, low), (second, "d_bucket", {"le": "+Inf", "op": "x"}, high)]
    row = metrics.quantile_of_rates(samples(spark, rows), "d", 60, 0.4).first()
    assert row.quantile == 0.5


@pytest.mark.parametrize("quantile", [0.0, 0.95])
def test_exact_quantiles_of_any_values(spark, quantile):
    dice = random.Random(int(quantile * 100))
    groups = {
        "hot": [dice.gauss(0, 1e6) for _ in range(3000)],
        "ties": [float(dice.randrange(4)) for _ in range(500)],
        "far": [10.0 ** dice.randrange(-20, 20) for _ in range(200)],
        "close": [1.0 + i * 2.0**-52 for i in range(50)],
        "one": [7.5],
        None: [-1.0, 2.0],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("hot", None), ("hot", float("nan")), ("none", None)]
    frame = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.observations, r.quantile) for r in metrics.exact_quantile(frame, "v", quantile, ["g"], pieces=64).collect()}
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        ordered, at = sorted(values), (len(values) - 1) * quantile
        low, high = ordered[int(at)], ordered[-int(-at // 1)]
        assert got[g] == (len(values), low if low == high else low + (high - low) * (at - int(at)))
    everything = metrics.exact_quantile(frame, "v", 1.0).collect()
    assert [(r.observations, r.quantile) for r in everything] == [(3753, max(v for _, v in rows if v == v and v is not None))]
    assert metrics.exact_quantile(frame.where("g = 'none'"), "v", 0.5, ["g"]).count() == 0


def test_exact_quantile_with_endless_values(spark):
    rows = [(float("-inf"),), (1.0,), (2.0,), (3.0,), (float("inf"),), (float("inf"),)]
    frame = spark.createDataFrame(rows, "v double")
    assert [metrics.exact_quantile(frame, "v", q).first().quantile for q in (0.2, 0.4, 1.0)] == [1.0, 2.0, float("inf")]
