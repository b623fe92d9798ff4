"""Property tests: parsing round-trips, dedupe idempotence, monotone row
counts through the cleaning steps."""

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from demandlens.operators import clean as C
from demandlens.plans import catalog as K
from demandlens.plans.pipelines import parse_stage
from demandlens.sources.readers import RAW_SCHEMA

ints = st.lists(st.integers(min_value=-(10**15), max_value=10**15), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(ints)
def test_demand_text_round_trips(spark, values):
    rows = []
    for v in values:
        rows += [(str(v), v), (f" {v} ", v), (f"{v}.99", v)]
        if v >= 0:
            rows.append((f"({v})", -v))
    df = spark.createDataFrame([("P", "W", "C", "2015/01/15", t) for t, _ in rows], RAW_SCHEMA)
    got = [r.Order_Demand for r in C.parse_order_demand(df).collect()]
    assert got == [want for _, want in rows]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(min_value=__import__("datetime").date(1990, 1, 1),
                         max_value=__import__("datetime").date(2030, 12, 31)), min_size=1, max_size=20))
def test_dates_round_trip_all_layouts(spark, days):
    texts = []
    for d in days:
        texts += [(f"{d.year}/{d.month}/{d.day}", d), (d.strftime("%m/%d/%Y"), d), (d.isoformat(), d)]
    df = spark.createDataFrame([("P", "W", "C", t, "1") for t, _ in texts], RAW_SCHEMA)
    got = [r.Date for r in C.parse_date(df, ["yyyy/M/d", "M/d/yyyy", "yyyy-M-d"]).collect()]
    assert got == [d for _, d in texts]


def test_dedupe_idempotent_and_counts_monotone(spark):
    raw = K._raw(spark, SF_SMALL)
    once = parse_stage(raw)
    twice = parse_stage(raw.unionByName(raw))
    assert once.count() == twice.count()
    n_raw, n_parsed = raw.count(), once.count()
    n_kept = C.drop_negative_demand(once).count()
    n_base = K._base(spark, SF_SMALL).count()
    n_clean = K.q_clean_demand(spark, SF_SMALL).count()
    assert n_raw >= n_parsed >= n_kept >= n_base == n_clean > 0
