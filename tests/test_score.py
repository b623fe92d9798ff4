import datetime as dt

import pytest

from demandlens.operators import score as SC

SCHEMA = "Product_Code string, Warehouse string, Product_Category string, Order_Demand bigint, Date date"


def history(spark, days):
    rows = [("P", "WHSE_S", "CAT", 10 * (i + 1), dt.date(2016, 1, 1) + dt.timedelta(days=i)) for i in range(days)]
    return spark.createDataFrame(rows, SCHEMA)


def req(spark, *dates):
    return spark.createDataFrame([("whse_s ", "cat", d) for d in dates], SC.REQUEST_SCHEMA)


def test_exactly_seven_days(spark):
    r = SC.request_features(req(spark, "2016-01-08"), history(spark, 7)).first()
    assert r.history_days == 7 and not r.insufficient_history
    assert r.rolling_7d_mean == 40.0
    assert r.demand_T_minus_2 == 60.0  # second-last observation
    assert (r.year, r.month, r.day_of_week, r.is_monday) == (2016, 1, 6, 0)


def test_six_days_flagged(spark):
    r = SC.request_features(req(spark, "2016-01-07"), history(spark, 7)).first()
    assert r.history_days == 6 and r.insufficient_history


def test_history_strictly_before_target(spark):
    r = SC.request_features(req(spark, "2016-01-05"), history(spark, 30)).first()
    assert r.history_days == 4 and r.rolling_7d_mean == 25.0


def test_bad_date_flagged(spark):
    r = SC.request_features(req(spark, "2016-13-45"), history(spark, 10)).first()
    assert r.valid_request is False


def test_missing_fields_raise(spark):
    with pytest.raises(ValueError):
        SC.validate_requests(spark.createDataFrame([("a",)], "warehouse string"))


def test_repeated_requests_each_get_features(spark):
    rows = SC.request_features(req(spark, "2016-01-08", "2016-01-08", "2016-01-05", "bad"), history(spark, 10)).collect()
    assert len(rows) == 4
    assert sorted((r.target_date, r.history_days) for r in rows if r.valid_request) == [
        ("2016-01-05", 4), ("2016-01-08", 7), ("2016-01-08", 7)]
