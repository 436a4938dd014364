"""Indicators re-aggregated from the one-pass cube equal the direct per-indicator queries."""

from cabflow.operators import cube as cb
from cabflow.operators import indicators as ind
from cabflow.operators.normalize import valid_trips
from cabflow.sources.fixture import fixture_trips


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_cube_matches_direct(spark):
    v = valid_trips(fixture_trips(spark, "/root/testdata/sf0.01"))
    dash = cb.dashboard(v)
    direct = {
        "monthly_indicators": ind.monthly_indicators(v),
        "yearly_indicators": ind.yearly_indicators(v),
        "yearly_indicators_raw": ind.yearly_indicators_raw(v),
        "payment_mix": ind.payment_mix(v),
        "payment_share": ind.payment_share(v),
        "pickup_hour": ind.pickup_hour(v),
        "totals": ind.totals(v),
    }
    for name, df in direct.items():
        assert _rows(dash[name]) == _rows(df), name
