import random
import re

import pytest

from conftest import SF_SMALL
from demandlens.operators.dedupe import drop_duplicates_in_two_phases
from demandlens.plans import catalog as K

SCHEMA = "a string, b string, c long"


def _rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("bound", [64 << 20, 0])
def test_same_rows_as_comparing_everything(spark, bound):
    rnd = random.Random(2)
    kinds = [(rnd.choice(["x", "", None]), rnd.choice(["x", "y", None]), rnd.choice([1, None])) for _ in range(30)]
    # nulls leave a fingerprint alone: different rows may share one
    rows = kinds + [("x", None, 1), (None, "x", 1)] + [(f"u{k}", "v", k) for k in range(50)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert _rows(drop_duplicates_in_two_phases(df, bound)) == sorted(set(rows), key=str)


def test_no_rows_and_no_repeats(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert drop_duplicates_in_two_phases(none).collect() == []
    single = spark.createDataFrame([("a", "b", k) for k in range(5)], SCHEMA)
    assert _rows(drop_duplicates_in_two_phases(single)) == _rows(single)


def test_one_row_many_times(spark):
    df = spark.range(20000).selectExpr("'same' AS a", "CAST(NULL AS STRING) AS b", "id % 2 AS c").repartition(6)
    assert _rows(drop_duplicates_in_two_phases(df)) == [("same", None, 0), ("same", None, 1)]


def test_rows_that_do_not_repeat_keep_their_partition(spark):
    df = drop_duplicates_in_two_phases(K._raw(spark, SF_SMALL))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    unique = plan[: plan.index("LeftSemi")]
    assert "LeftAnti" in unique
    # the one shuffle by columns is that of the candidates, above the semi join
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert len(keys) == 1 and "Product_Code" in keys[0]
    assert plan.index("LeftAnti") < plan.index("Exchange hashpartitioning") < plan.index("LeftSemi")
