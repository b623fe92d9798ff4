from conftest import SF_SMALL
from demandlens.config import DEFAULT_MODELS, CleanConfig, TrainConfig
from demandlens.plans import catalog as K
from demandlens.plans.jobs import clean_job, train_job
from demandlens.session import scratch_path
from demandlens.sources.readers import read_cleaned
from demandlens.streaming.ingest import start_ingest


def _land_csv(spark, df, path, parts):
    (df.repartition(parts).write.mode("overwrite").option("header", "true")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def test_clean_and_train_jobs(spark):
    raw_csv = scratch_path(spark, "raw")
    _land_csv(spark, K._raw(spark, SF_SMALL), raw_csv, 2)
    out = scratch_path(spark, "cleaned")
    m = clean_job(spark, raw_csv, out, CleanConfig(min_records_per_product=20))
    expected = K.q_clean_demand(spark, SF_SMALL).count()
    assert m["rows"] == expected
    assert read_cleaned(spark, out).count() == expected
    flagged_out = scratch_path(spark, "flagged")
    m2 = clean_job(spark, raw_csv, flagged_out, CleanConfig(min_records_per_product=20, keep_flags=True))
    flagged = read_cleaned(spark, flagged_out)
    assert m2["rows"] == expected and "is_outlier" in flagged.columns
    want = K._clean_from_raw(spark, SF_SMALL, keep_flags=True).filter("is_outlier").count()
    assert flagged.filter("is_outlier").count() == want
    cfg = TrainConfig(test_year=2001, num_trees=3, boost_iters=3, high_demand_threshold=4000.0,
                      models=(DEFAULT_MODELS[0], DEFAULT_MODELS[2]))
    res = train_job(spark, out, cfg)
    assert res["winner"] in cfg.models and len(res["leaderboard"]) == 2
    assert res["slice"]["slice_rows"] > 0 and res["slice"]["incomplete_rows"] == 0


def test_streaming_ingest_equals_batch(spark):
    landing = scratch_path(spark, "landing")
    raw = K._raw(spark, SF_SMALL)
    _land_csv(spark, raw, landing + "/a", 3)
    _land_csv(spark, raw.limit(100), landing + "/b", 1)  # re-delivered rows: duplicates
    out = scratch_path(spark, "stream-out")
    q = start_ingest(spark, landing + "/*", out, available_now=True)
    q.awaitTermination(300)
    got = read_cleaned(spark, out)
    want = K.q_clean_demand(spark, SF_SMALL)
    assert got.count() == want.count()
    cols = sorted(want.columns)
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
