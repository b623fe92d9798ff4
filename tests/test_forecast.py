import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlens.config import DEFAULT_MODELS, FEATURE_COLUMNS, TrainConfig
from demandlens.operators import evaluate as EV
from demandlens.operators import forecast as FC
from demandlens.operators import registry as RG
from demandlens.plans.jobs import train_groups
from demandlens.sources.sinks import leaderboard_document


def featured(spark, n=120, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        d = dt.date(1999, 1, 1) + dt.timedelta(days=7 * i)
        f = [d.year, d.month, (d.isoweekday() % 7) + 1, d.isocalendar()[1],
             int(rng.integers(0, 5000)), float(rng.random() * 900), float(rng.random() * 3000),
             int(d.month >= 10), int(d.isoweekday() == 1)]
        y = int(abs(2 * f[6] + f[4] / 3 + rng.normal(0, 200)))
        rows.append(("P%d" % (i % 3), "WHSE_S", "CATEGORY_019", y, d, *f))
    cols = ["Product_Code", "Warehouse", "Product_Category", "Order_Demand", "Date", *FEATURE_COLUMNS]
    df = spark.createDataFrame(rows, cols)
    return df.withColumns({c: df[c].cast("int") for c in ("year", "month", "day_of_week", "week_of_year", "is_q4", "is_monday")})


def test_ridge_matches_closed_form(spark):
    df = featured(spark)
    train, test = FC.train_test(df, 2000)
    _, pred = FC.fit_predict(DEFAULT_MODELS[0], train, test, TrainConfig(test_year=2000))
    tr, te = train.toPandas(), test.toPandas()
    X = tr[list(FEATURE_COLUMNS)].to_numpy(float)
    mu, sd = X.mean(0), X.std(0)
    sd[sd == 0] = 1.0
    Xs = (X - mu) / sd
    y = np.log1p(tr["Order_Demand"].to_numpy(float))
    w = np.linalg.solve(Xs.T @ Xs + np.eye(X.shape[1]), Xs.T @ (y - y.mean()))
    Xt = (te[list(FEATURE_COLUMNS)].to_numpy(float) - mu) / sd
    want = np.clip(np.expm1(Xt @ w + y.mean()), 0, None)
    got = pred.toPandas().set_index("Date").loc[te["Date"], "prediction"].to_numpy()
    assert np.allclose(got, want, rtol=1e-6, atol=1e-6)


@pytest.mark.parametrize("name", [DEFAULT_MODELS[2], DEFAULT_MODELS[3], DEFAULT_MODELS[4], DEFAULT_MODELS[1]])
def test_contenders_fit_and_predict(spark, name):
    df = featured(spark, 80)
    train, test = FC.train_test(df, 2000)
    cfg = TrainConfig(test_year=2000, num_trees=5, boost_iters=5)
    model, pred = FC.fit_predict(name, train, test, cfg)
    rows = pred.collect()
    assert len(rows) == test.count() > 0
    assert all(r.prediction is not None for r in rows)
    if name == DEFAULT_MODELS[1]:
        assert all(r.prediction >= 0 for r in rows)
    # deterministic with the seed
    _, again = FC.fit_predict(name, train, test, cfg)
    assert sorted(r.prediction for r in again.collect()) == sorted(r.prediction for r in rows)


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([("m", 10, 5.0), ("m", 20, 6.0)], "model string, Order_Demand bigint, prediction double")
    r = EV.forecast_metrics(df, threshold=100).first()
    assert (r.mae, r.accuracy, r.f1, r.precision, r.recall) == (9.5, 1.0, 0.0, 0.0, 0.0)


def test_metrics_values(spark):
    rows = [("m", 200, 150.0), ("m", 50, 150.0), ("m", 200, 20.0), ("m", 10, 10.0)]
    df = spark.createDataFrame(rows, "model string, Order_Demand bigint, prediction double")
    r = EV.forecast_metrics(df, threshold=100).first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.5, 0.5, 0.5, 0.5)


def test_tournament_and_registry(spark, tmp_path):
    df = featured(spark, 80)
    cfg = TrainConfig(test_year=2000, num_trees=3, boost_iters=3, models=(DEFAULT_MODELS[0], DEFAULT_MODELS[2]))
    board, models, _ = FC.run_tournament(df, cfg)
    rows = board.orderBy("rank").collect()
    assert [r.rank for r in rows] == [1, 2] and rows[0].is_winner
    assert rows[0].mae <= rows[1].mae
    paths = RG.save_models(models, rows[0].model, str(tmp_path / "models"))
    assert any(p.endswith("_best") for p in paths.values())
    reg = str(tmp_path / "registry")
    RG.register(spark, reg, "demand", board, paths)
    RG.register(spark, reg, "demand", board, paths)
    table = RG.versions(spark, reg)
    assert sorted(r.version for r in table.collect()) == [1, 2, 3, 4]
    assert RG.current_versions(spark, reg).filter("alias = 'Production'").count() == 1
    doc = json.loads(leaderboard_document(board).first().value)
    assert list(doc) == [r.model for r in rows] and set(doc[rows[0].model]) == {"MAE", "Accuracy", "F1", "Precision", "Recall"}
    model, version = RG.load_by_alias(spark, reg, "demand")
    assert "@Production" in version
    assert model.transform(df).count() == df.count()


def test_registry_versions_keep_their_models_and_errors_lose_nothing(spark, tmp_path):
    df = featured(spark, 80)
    reg = str(tmp_path / "registry")
    seen = []
    for trees in (1, 4):
        cfg = TrainConfig(test_year=2000, num_trees=trees, models=(DEFAULT_MODELS[2],))
        board, models, _ = FC.run_tournament(df, cfg)
        paths = RG.save_models(models, DEFAULT_MODELS[2], str(tmp_path / "models"))
        RG.register(spark, reg, "demand", board, paths)
        model, version = RG.load_by_alias(spark, reg, "demand")
        seen.append((version, model.stages[1].getNumTrees))
    assert [n for _, n in seen] == [1, 4] and seen[0][0] != seen[1][0]
    first = RG.versions(spark, reg).filter("version = 1").first()
    assert RG.PipelineModel.load(first.path).stages[1].getNumTrees == 1
    files = sorted(tmp_path.joinpath("registry").glob("*/*.json"))
    kept = files[1].read_bytes()
    files[0].write_bytes(b"damaged")
    with pytest.raises(Exception):
        RG.load_by_alias(spark, reg, "demand")
    RG.add_version(spark, reg, {"registry_name": "demand", "model": "m", "path": "p"})
    assert files[0].read_bytes() == b"damaged" and files[1].read_bytes() == kept


def test_two_writers_share_no_version(spark, tmp_path):
    reg = str(tmp_path / "registry")

    def write(writer):
        return [
            RG.add_version(spark, reg, {"registry_name": "demand", "model": f"{writer}-{k}", "path": "p"})
            for k in range(10)
        ]

    with ThreadPoolExecutor(2) as pool:
        taken = list(pool.map(write, ("one", "two")))
    assert sorted(v for versions in taken for v in versions) == list(range(1, 21))
    rows = RG.versions(spark, reg).collect()
    assert sorted(r.version for r in rows) == list(range(1, 21))
    assert {r.model for r in rows} == {f"{w}-{k}" for w in ("one", "two") for k in range(10)}
    # a writer that died after it had taken a number
    folder = next(tmp_path.joinpath("registry").iterdir())
    folder.joinpath("0000000021.json").write_text("")
    assert RG.add_version(spark, reg, {"registry_name": "demand", "model": "m", "path": "p"}) == 22
    assert RG.versions(spark, reg).count() == 21
    # names whose slugs agree have numbers of their own
    assert RG.add_version(spark, reg, {"registry_name": "Demand!", "model": "m", "path": "p"}) == 1


def test_group_tournament_trains_every_group(spark):
    df = featured(spark, 90).withColumn("Warehouse", F.concat(F.lit("W"), F.col("month") % 2))
    late = df.filter("year = 2000").limit(1).withColumn("Warehouse", F.lit("new"))
    cfg = TrainConfig(test_year=2000, boost_iters=3, group_cols=("Warehouse",))
    board, models, preds = FC.run_group_tournament(df.unionByName(late), cfg)
    trained = [m for m in DEFAULT_MODELS if m != DEFAULT_MODELS[2]]  # the forest is for a slice
    assert set(models) == set(trained)
    rows = board.collect()
    assert {(r.Warehouse, r.model) for r in rows} == {(w, m) for w in ("W0", "W1") for m in trained}
    for w in ("W0", "W1"):
        here = sorted([r for r in rows if r.Warehouse == w], key=lambda r: r["rank"])
        assert [r["rank"] for r in here] == [1, 2, 3, 4] and here[0].is_winner
        assert here == sorted(here, key=lambda r: (r.mae, r.model))
    alone = preds.filter("Warehouse = 'new'").collect()
    assert len(alone) == 4 and all(r.prediction is None for r in alone)
    with pytest.raises(ValueError):
        FC.run_group_tournament(df, TrainConfig(test_year=2000))


def test_group_job_writes_models_and_leaderboard(spark, tmp_path):
    cfg = TrainConfig(test_year=2000, boost_iters=2, group_cols=("Product_Code",), models=DEFAULT_MODELS[:1] + DEFAULT_MODELS[3:4])
    got = train_groups(featured(spark, 80), cfg, str(tmp_path / "models"), str(tmp_path / "reports"))
    assert got["groups"] == 3 and spark.read.parquet(got["leaderboard"]).count() == 6
    for path in got["models"].values():
        assert spark.read.parquet(path).select("Product_Code").distinct().count() == 3


def test_rank_uses_the_full_precision(spark):
    rows = [("b", 0, 0.00001), ("a", 0, 0.00002)]
    preds = spark.createDataFrame(rows, "model string, Order_Demand bigint, prediction double")
    assert [r.model for r in EV.leaderboard(EV.forecast_metrics(preds, 1)).orderBy("rank").collect()] == ["b", "a"]


def test_registered_learners_run_in_full(spark, monkeypatch):
    """The boosted queries fit TrainConfig's default rounds, and the companion
    of the tournament is taken from the tournament's own configuration."""
    from demandlens.plans import catalog

    seen = []

    class Fitted(Exception):
        pass

    def caught(*args):
        seen.append(args[-1])
        raise Fitted

    monkeypatch.setattr(catalog, "_split", lambda spark, sf: (None, None))
    monkeypatch.setattr(catalog, "_featured", lambda spark, sf: None)
    monkeypatch.setattr(FC, "fit_predict", caught)
    monkeypatch.setattr(FC, "run_tournament", caught)
    for key in ("gbt_forecast", "leafwise_boosting_forecast", "forecast_tournament", "tournament_test_rows"):
        with pytest.raises(Fitted):
            catalog.QUERIES[key](spark, "")
    full = TrainConfig(test_year=0)
    assert [(c.boost_iters, c.num_trees) for c in seen] == [(full.boost_iters, full.num_trees)] * 4
    for name in DEFAULT_MODELS[3:]:
        assert FC.build_contender(name, None, seen[0]).getStages()[-1].params_.rounds == 500


def test_boosting_beats_the_forest_on_its_training_rows(spark):
    train, _ = FC.train_test(featured(spark, 120), 2001)
    cfg = TrainConfig(test_year=2001)

    def error(name):
        model = FC.fit(name, train, cfg)
        return model.transform(train).agg(F.avg(F.abs(F.col("Order_Demand") - F.col("prediction")))).first()[0]

    forest = error(DEFAULT_MODELS[2])
    assert error(DEFAULT_MODELS[3]) < forest


def test_sides_of_a_slice_are_in_partitions_by_their_rows(spark):
    rows = spark.range(0, 900, 1, 40).withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    train, test = FC.materialise_sides(rows)
    assert train.rdd.getNumPartitions() == test.rdd.getNumPartitions() == 1
    assert sorted(r.id for r in train.collect()) == [k for k in range(900) if k % 3]
    assert sorted(r.id for r in test.collect()) == list(range(0, 900, 3))
    assert train.columns == ["id"]
    none, _ = FC.materialise_sides(rows.filter("split = 'test'"))
    assert none.count() == 0


def test_groups_have_forests_of_their_own(spark):
    """In one task, and by MLlib where a group has more rows than one trains."""
    df = featured(spark, 90).withColumn("Warehouse", F.concat(F.lit("W"), F.col("month") % 2))
    cfg = TrainConfig(test_year=2000, num_trees=20, boost_iters=2, group_cols=("Warehouse",))
    board, models, preds = FC.run_group_tournament(df, cfg, cfg.models)
    rows = board.collect()
    assert set(models) == set(DEFAULT_MODELS)
    assert {(r.Warehouse, r.model) for r in rows} == {(w, m) for w in ("W0", "W1") for m in DEFAULT_MODELS}
    assert sorted(r["rank"] for r in rows if r.Warehouse == "W0") == [1, 2, 3, 4, 5]
    found = preds.filter(F.col("model") == DEFAULT_MODELS[2]).toPandas()
    assert len(found) == df.filter("year = 2000").count() and found.prediction.notna().all()
    # about what MLlib's forest of the group's rows gives
    train, test = FC.train_test(df.filter("Warehouse = 'W0'"), 2000)
    alone = FC.spread_forest(train, cfg)
    tested = test.toPandas().sort_values("Date")
    want = alone.predict(tested[list(FEATURE_COLUMNS)].to_numpy(float))
    got = found[found.Warehouse == "W0"].sort_values("Date").prediction.to_numpy()
    assert np.corrcoef(got, want)[0, 1] > 0.9
    usual = np.abs(tested.Order_Demand - train.toPandas().Order_Demand.mean()).mean()
    assert np.abs(tested.Order_Demand - got).mean() < 0.6 * usual


def test_the_group_query_trains_every_contender(spark, monkeypatch):
    from demandlens.plans import catalog

    df = featured(spark, 60)
    monkeypatch.setattr(catalog, "_featured", lambda spark, sf: df)
    few = TrainConfig(test_year=2000, num_trees=2, boost_iters=2, group_cols=("Warehouse", "Product_Category"))
    monkeypatch.setattr(catalog, "GROUP_CFG", few)
    rows = catalog.QUERIES["group_leaderboard"](spark, "").collect()
    assert {r.model for r in rows} == set(DEFAULT_MODELS) and sorted(r["rank"] for r in rows) == [1, 2, 3, 4, 5]
