import datetime as dt

import pytest

from meterlake import Params

DAY = dt.date(2024, 3, 10)


def test_defaults():
    p = Params(as_of=DAY)
    assert (p.days_minus_hourly, p.days_minus_daily, p.sigma, p.months, p.min_usage) == (-2, -62, 2.5, 15, 3000)
    assert (p.leak_hours, p.leak_min, p.parity) == (24, 5, False)
    assert p.as_of_ts == dt.datetime(2024, 3, 10)


@pytest.mark.parametrize("bad", [{"days_minus_hourly": 0}, {"days_minus_daily": 3}, {"months": 0},
                                 {"leak_hours": 0}, {"min_readings": 0}])
def test_rejected(bad):
    with pytest.raises(ValueError):
        Params(as_of=DAY, **bad)


def test_horizon_is_read_as_a_number():
    assert Params(as_of=DAY, days_minus_hourly="-3").days_minus_hourly == -3
    with pytest.raises(ValueError):
        Params(as_of=DAY, days_minus_hourly="-abc")


def test_run_time_is_kept_in_utc():
    zone = dt.timezone(dt.timedelta(hours=-5))
    p = Params(as_of=DAY, as_of_ts=dt.datetime(2024, 3, 10, 1, tzinfo=zone))
    assert p.as_of_ts == dt.datetime(2024, 3, 10, 6)


def test_from_json():
    p = Params.from_json(
        '{"as_of": "2024-03-10", "as_of_ts": "2024-03-10T01:00:00", "districts": "A, B", "parity": "true",'
        ' "sigma": "3"}'
    )
    assert (p.as_of, p.districts, p.parity, p.sigma) == (DAY, ("A", "B"), True, 3.0)
    with pytest.raises(ValueError):
        Params.from_json('{"as_of": "2024-03-10", "typo": 1}')
    with pytest.raises(ValueError):
        Params.from_json("{}")
