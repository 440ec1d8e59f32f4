import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.models import boost, forest, matrix
from riskloom.models.trees import Ensemble, feature_importance, leaf_values

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    n = 3000
    x = rng.normal(size=(n, 3))
    x[:, 2] = rng.integers(0, 2, n)
    y = (x[:, 0] + 0.3 * rng.normal(size=n)) > 1.5
    x[:20] += [9, -9, 0]
    pdf = pd.DataFrame(x, columns=COLUMNS).assign(id=[f"r{i}" for i in range(n)], y=y, odd=np.arange(n) < 20)
    return spark.createDataFrame(pdf).repartition(5).cache()


def scored(rows, model):
    return forest.score_forest(rows, model).toPandas().set_index("id").sort_index()


def test_forest(spark, rows, tmp_path):
    model = forest.fit_forest(rows, COLUMNS, "id", trees=40, sample=256)
    assert model.trees == 40 and len(model.nodes) <= 40 * (2 * 256 - 1)
    out = scored(rows, model)
    score = out["isolation_anomaly_score"].astype(float)
    assert score.between(0, 100).all() and score.max() == 100
    assert score[out["odd"]].min() > score[~out["odd"]].median()
    assert score[out["odd"]].mean() > 5 * score[~out["odd"]].mean()

    again = forest.fit_forest(rows.repartition(2), COLUMNS, "id", trees=40, sample=256)
    pd.testing.assert_frame_equal(
        again.nodes.sort_values(["tree", "node"], ignore_index=True),
        model.nodes.sort_values(["tree", "node"], ignore_index=True),
    )
    other = forest.fit_forest(rows, COLUMNS, "id", trees=40, sample=256, seed=7)
    assert not other.nodes["threshold"].equals(model.nodes["threshold"])

    model.save(spark, str(tmp_path / "m"))
    loaded = Ensemble.load(spark, str(tmp_path / "m"))
    pd.testing.assert_series_equal(scored(rows, loaded)["isolation_anomaly_score"], out["isolation_anomaly_score"])


def test_forest_samples_exactly(spark, rows):
    model = forest.fit_forest(rows, COLUMNS, "id", trees=10, sample=200)
    drawn = forest.sample_trees(rows, rows.count(), "id", 10, 200, 42).groupBy("tree").count().collect()
    assert all(200 <= r["count"] <= 200 + 16 * 200**0.5 for r in drawn)
    assert model.params["sample"] == 200
    small = forest.fit_forest(rows.limit(50), COLUMNS, "id", trees=5, sample=4096)
    assert small.params["sample"] == 50


def test_grown_tree_is_sound():
    x = np.random.default_rng(1).normal(size=(500, 4))
    nodes = forest._grow(x, 9, np.random.default_rng(2))
    inner = nodes[nodes["feature"] >= 0]
    assert nodes["node"].tolist() == list(range(len(nodes)))
    assert sorted([*inner["child"], *(inner["child"] + 1)]) == list(range(1, len(nodes)))
    depth = Ensemble("t", ("a",) * 4, nodes.assign(tree=0, gain=0.0))
    values = leaf_values(depth.arrays(), x)[0]
    assert values.mean() == pytest.approx(float(forest.mean_path(500)), rel=0.25)
    flat = forest._grow(np.ones((8, 3)), 5, np.random.default_rng(3))
    assert len(flat) == 1 and flat["value"][0] == pytest.approx(float(forest.mean_path(8)))


def test_leaf_values_walk_row_by_row():
    """Also with NaN, rows stored by features, no rows, and trees of one leaf."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 4))
    x[::7, 1], x[::11, 2] = np.nan, np.inf
    grown = [forest._grow(rng.normal(size=(n, 4)), 6, rng).assign(tree=k, gain=0.0) for k, n in enumerate((200, 1, 60))]
    trees = Ensemble("t", ("a",) * 4, pd.concat(grown)).arrays()

    def walk(nodes, row):
        at = 0
        while nodes["feature"][at] >= 0:
            at = nodes["child"][at] + int(row[nodes["feature"][at]] > nodes["threshold"][at])
        return nodes["value"][at]

    want = np.array([[walk(nodes.to_dict("list"), row) for row in x] for nodes in grown])
    by_feature = np.asfortranarray(x)
    for given in (x, by_feature, by_feature[100:300]):
        assert np.array_equal(leaf_values(trees, given), want[:, 100:300] if len(given) < 400 else want)
    assert leaf_values(trees, x[:0]).shape == (3, 0)


def test_mean_path():
    assert forest.mean_path(1) == 0 and forest.mean_path(2) == 1
    assert float(forest.mean_path(256)) == pytest.approx(10.244, abs=1e-2)


def keys(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    return np.array([r[0] for r in df.select(F.xxhash64("id")).collect()])


def brute_boost(x, y, keys, rounds, rate, depth=5, bins=256, seed=42):
    """Margins of the training rows after each round: every cut between two values tried at every node."""
    weight = float((~y).sum() / y.sum())
    w = np.where(y, weight, 1.0)
    bounds = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            order = np.argsort(column, kind="stable")
            upto = np.cumsum(w[order])
            values = np.unique(column[order][[np.flatnonzero(upto >= upto[-1] * k / bins - 1e-9)[0] for k in range(1, bins)]])
            values = np.append(values[values < column.max()], np.inf)
        bounds.append(values[:-1])
    scale = boost.whole_scale(len(x), weight)
    margin, out = np.zeros(len(x)), []
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * w * scale) / scale, np.rint(p * (1 - p) * w * scale) / scale
        used = boost.drawn_rows(keys, seed, r)
        columns = boost.drawn_columns(x.shape[1], seed, r)

        def grow(rows, level):
            sampled = rows & used
            total_g, total_h = g[sampled].sum(), h[sampled].sum()
            best = (1e-6, None)
            for f in columns if level < depth else ():
                for cut in bounds[f]:
                    left = sampled & (x[:, f] <= cut)
                    lg, lh = g[left].sum(), h[left].sum()
                    if min(lh, total_h - lh) < 3:
                        continue
                    gain = lg**2 / (lh + 1) + (total_g - lg) ** 2 / (total_h - lh + 1) - total_g**2 / (total_h + 1)
                    if gain > best[0] * (1 + 1e-12):
                        best = (gain, (f, cut))
            if best[1] is None:
                margin[rows] += -rate * total_g / (total_h + 1)
                return
            f, cut = best[1]
            for side in (rows & (x[:, f] <= cut), rows & ~(x[:, f] <= cut)):
                grow(side, level + 1)

        grow(np.ones(len(x), bool), 0)
        out.append(margin.copy())
    return out


@pytest.mark.parametrize("bins", [256, 24])
def test_boost_equals_brute_force(spark, rows, bins):
    some = rows.filter("xxhash64(id) % 5 = 0").select("id", F.round("a", 1).alias("a"), F.round("b", 1).alias("b"), "c", "y").cache()
    pdf = some.toPandas()
    want = brute_boost(pdf[COLUMNS].to_numpy(), pdf["y"].to_numpy(), keys(spark, pdf["id"]), 5, 0.3, bins=bins)[-1]
    models = [
        boost.fit_boost(part, part, COLUMNS, "y", "id", max_trees=5, learning_rate=0.3, patience=99, max_bins=bins)
        for part in (some, some.repartition(7))
    ]
    assert models[0].nodes.equals(models[1].nodes)  # however the rows are partitioned
    trees = models[0].params["trees"]
    model = models[0]
    if trees < 5:
        want = brute_boost(pdf[COLUMNS].to_numpy(), pdf["y"].to_numpy(), keys(spark, pdf["id"]), trees, 0.3, bins=bins)[-1]
    got = leaf_values(model.arrays(), pdf[COLUMNS].to_numpy()).sum(axis=0)
    assert np.abs(got - want).max() <= 1e-9


def test_boost_sums_on_executors_and_constant_columns(spark, rows, monkeypatch):
    part = rows.withColumn("c", F.lit(1.0))
    fit = lambda: boost.fit_boost(part, part, COLUMNS, "y", "id", max_trees=3, learning_rate=0.3)
    want = fit()
    monkeypatch.setattr(boost, "_DIRECT", 0)
    got = fit()
    assert got.nodes.equals(want.nodes) and not (got.nodes["feature"] == 2).any()
    with pytest.raises(ValueError):
        boost.fit_boost(part, part, COLUMNS, "y", "id", max_bins=300)


def test_boost(spark, rows):
    train, valid = rows.filter("id < 'r2'"), rows.filter("id >= 'r2'")
    model = boost.fit_boost(train, valid, COLUMNS, "y", "id", max_trees=12, patience=4, learning_rate=0.3)
    assert 1 <= model.trees <= 12
    out = boost.score_boost(valid, model, "p").toPandas()
    p = out["p"].astype(float)
    assert p.between(0, 1).all() and p[out["y"]].mean() > p[~out["y"]].mean() + 0.3
    assert model.params["valid_ap"] > 3 * out["y"].mean()
    shares = feature_importance(model, spark).collect()
    assert shares[0].feature == "a" and sum(r.importance for r in shares) == pytest.approx(1, abs=1e-3)


def test_early_stop_equals_cutting_after_all_rounds(spark, rows):
    from tests.test_scoring import brute_ranking

    train, valid = rows.filter("id < 'r2'"), rows.filter("id >= 'r2'")
    fit = lambda **more: boost.fit_boost(train, valid, COLUMNS, "y", "id", learning_rate=0.5, **more)
    stopped, longest = fit(max_trees=40, patience=3), fit(max_trees=12, patience=99)
    assert stopped.params["tried"] < 40
    whole = fit(max_trees=stopped.params["tried"], patience=99)
    assert whole.first(stopped.trees).nodes.equals(stopped.nodes.iloc[: len(whole.first(stopped.trees).nodes)])
    # The precision of every size, from scores alone.
    found = []
    for k in range(1, longest.trees + 1):
        data = boost.score_boost(valid, longest.first(k), "p").select("p", "y").collect()
        found.append(brute_ranking([(float(d.p), d.y) for d in data])[1])
    assert longest.params["valid_ap"] == pytest.approx(max(found), abs=1e-4) == pytest.approx(found[-1], abs=1e-4)


def test_boost_goes_on_from_its_last_stored_round(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(boost, "STORE_EVERY", 2)
    fit = lambda **more: boost.fit_boost(rows, rows, COLUMNS, "y", "id", max_trees=7, learning_rate=0.3, **more)
    want = fit()
    real, rounds = boost.drawn_columns, []

    def lost(count, seed, tree, share):
        rounds.append(tree)
        if tree == 5 and rounds.count(5) == 1:
            raise RuntimeError("the driver is lost")
        return real(count, seed, tree, share)

    monkeypatch.setattr(boost, "drawn_columns", lost)
    with pytest.raises(RuntimeError):
        fit(state=str(tmp_path / "state"))
    rounds.clear()
    rounds.append(5)
    got = fit(state=str(tmp_path / "state"))
    assert rounds[1] == 4 and got.nodes.equals(want.nodes) and got.params == want.params


def test_columns_of_few_bins_share_bytes():
    bins = [256, 2, 24, 1, 7, 2, 100, 2, 256, 2]
    shared = boost.shared_bytes(bins)
    assert sorted(c for columns in shared for c, _, _ in columns) == list(range(len(bins))) and len(shared) == 5
    rows = np.random.default_rng(5).integers(0, bins, (200, len(bins)))
    for columns in shared:
        code = sum(rows[:, c] * step for c, step, _ in columns if bins[c] > 1)
        assert np.all(code < 256) and all((code // step % n == rows[:, c]).all() for c, step, n in columns)


@pytest.mark.parametrize("direct", [32, 0])
def test_boost_over_many_folders_stores_rows_once(spark, rows, monkeypatch, direct):
    """However many tasks hold the rows; without a state, trees do not write the rows and margins again."""
    fit = lambda: boost.fit_boost(rows, rows, COLUMNS, "y", "id", max_trees=5, learning_rate=0.3)
    want = fit()
    real, written = boost.scratch_path, []
    monkeypatch.setattr(boost, "scratch_path", lambda spark, name: written.append(name) or real(spark, name))
    for name, value in (("STORE_EVERY", 2), ("_TASK_ROWS", 1), ("_MOST_ROWS", 400), ("_BLOCK", 50), ("_DIRECT", direct)):
        monkeypatch.setattr(boost, name, value)
    assert fit().nodes.equals(want.nodes) and written.count("boost-rows") == 1


def test_boost_goes_on_without_its_folders(spark, rows, monkeypatch):
    """Rows on the executors' disks may go at any time, with their executor."""
    import os
    import shutil
    from pathlib import Path

    fit = lambda: boost.fit_boost(rows, rows, COLUMNS, "y", "id", max_trees=5, learning_rate=0.3)
    want = fit()
    homes = spark.sparkContext.range(1).map(lambda _: os.environ["SPARK_LOCAL_DIRS"]).first().split(",")
    real, calls, gone = boost.best_split, [], []

    def lost(hist, sizes, columns):
        calls.append(0)
        if len(calls) in (20, 45):
            found = [folder for home in homes for folder in Path(home).glob("boost-*")]
            gone.append(len(found))
            for folder in found:
                shutil.rmtree(folder)
        return real(hist, sizes, columns)

    monkeypatch.setattr(boost, "best_split", lost)
    got = fit()
    assert got.nodes.equals(want.nodes) and got.params == want.params and len(gone) == 2 and min(gone) > 0
    assert not any([*Path(home).glob("boost-*")] for home in homes)


@pytest.mark.parametrize("parts", [1, 9])
def test_quantile_summaries(spark, parts):
    from riskloom.models import quantiles

    rng = np.random.default_rng(4)
    x, w = rng.lognormal(size=(40_000, 2)), rng.integers(1, 5, 40_000).astype(float)
    x[::3, 1] = 2.0  # a third of the rows in one value
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "w": w})).repartition(parts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 700)
    try:
        found = quantiles.summaries(df, ["a", "b"], F.col("w"), quantiles.ENTRIES_PER_BIN * 16)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, summary in enumerate(found):
        assert len(summary[0]) <= 2 * quantiles.ENTRIES_PER_BIN * 16 and summary[1].sum() == pytest.approx(w.sum())
        at = rng.choice(x[:, k], 300)
        upto = np.concatenate([[0.0], np.cumsum(summary[1])])
        guess = upto[np.searchsorted(summary[0], at, side="right")]
        exact = np.array([w[x[:, k] <= v].sum() for v in at])
        assert np.abs(guess - exact).max() <= w.sum() / (4 * 16)
        assert len(quantiles.cuts(summary, 16)) <= 15
    few = quantiles.summaries(df.selectExpr("floor(a) as a", "w"), ["a"], F.col("w"), 64)[0]
    assert dict(zip(*few, strict=True)) == {v: w[np.floor(x[:, 0]) == v].sum() for v in np.unique(np.floor(x[:, 0]))}


def test_patience_rule():
    assert boost.best_size([0.1, 0.3, 0.2, 0.2, 0.9], 2) == (2, True)
    assert boost.best_size([0.1, 0.3, 0.2, 0.2, 0.9], 3) == (5, False)
    assert boost.best_size([0.5, 0.5, 0.5], 2) == (1, True)
    assert boost.best_size([None, None], 5) == (1, False)


def test_matrix_fills_missing_history(spark, make_fact, customers):
    from riskloom.plans.features import features

    out = matrix.model_matrix(features(make_fact([{"amount": "12.50"}]), customers))
    assert out.columns[1:] == matrix.matrix_columns() and len(matrix.matrix_columns()) == 30
    r = out.first()
    assert (r.avg_amount_7d, r.avg_amount_30d, r.amount_to_avg_7d_ratio) == (12.5, 12.5, 1.0)
    assert (r.minutes_since_prev_txn, r.km_from_prev_txn, r.has_history) == (43200.0, 0.0, 0.0)
    assert (r.cat_gas, r.cat_retail, r.is_online) == (1.0, 0.0, 1.0)


def test_rare_categories_share_a_column(spark, make_fact, customers):
    from riskloom.plans.features import features

    rows = [("b",), ("a",), ("b",), ("d",), ("c",), (None,), ("c",), ("c",)]
    df = spark.createDataFrame(rows, "merchant_category string")
    assert matrix.frozen_categories(df) == ("a", "b", "c", "d")
    assert matrix.frozen_categories(df, most=4) == ("a", "b", "c", "d")
    assert matrix.frozen_categories(df, most=3) == ("b", "c", matrix.RARE)
    assert matrix.frozen_categories(df, most=1) == (matrix.RARE,)
    assert matrix.frozen_categories(df.limit(0)) == ()

    feats = features(make_fact([{}] * 3), customers).drop("merchant_category")
    kinds = spark.createDataFrame([("gas",), ("new",), (None,), (matrix.RARE,)], "merchant_category string")
    made = matrix.model_matrix(feats.limit(1).crossJoin(kinds), ("merchant_category",), ("gas", matrix.RARE))
    assert made.columns[1:] == matrix.matrix_columns(("gas", matrix.RARE))
    got = {r.merchant_category: (r.cat_gas, r[f"cat_{matrix.RARE}"]) for r in made.collect()}
    assert got == {"gas": (1.0, 0.0), "new": (0.0, 1.0), None: (0.0, 0.0), matrix.RARE: (0.0, 1.0)}


def test_thousands_of_categories_get_a_model(spark, make_fact, customers):
    """Every row has exactly one category column set, however many values there are."""
    from riskloom.plans.features import features

    feats = features(make_fact([{}]), customers).drop("merchant_category")
    kinds = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 1500).alias("merchant_category"))
    rows = feats.crossJoin(kinds)
    listed = matrix.frozen_categories(rows, most=40)
    assert len(listed) == 40 and listed[-1] == matrix.RARE
    made = matrix.model_matrix(rows, categories=listed)
    total = sum(F.col(c) for c in made.columns if c.startswith("cat_"))
    assert [r[0] for r in made.select(total).distinct().collect()] == [1.0]


def test_workers_need_no_package(tmp_path):
    """Started outside the repository, workers cannot import the package."""
    import subprocess
    import sys
    from pathlib import Path

    script = tmp_path / "fit.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})\n"
        "from riskloom.session import local_session\n"
        "from riskloom.models import boost, forest\n"
        f"spark = local_session(2, 'outside', '1g', **{{'spark.checkpoint.dir': {str(tmp_path / 'c')!r}}})\n"
        "rows = spark.range(200).selectExpr('id', 'cast(id % 7 as double) a', 'cast(id % 11 as double) b', 'id % 7 > 4 y')\n"
        "model = forest.fit_forest(rows, ['a', 'b'], 'id', trees=4, sample=32)\n"
        "assert forest.score_forest(rows, model).count() == 200\n"
        "print(forest.score_forest(rows, model).agg({'isolation_anomaly_score': 'max'}).first())\n"
        "model = boost.fit_boost(rows, rows, ['a', 'b'], 'y', 'id', max_trees=2)\n"
        "print(boost.score_boost(rows, model).agg({'xgb_fraud_probability': 'max'}).first())\n"
    )
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_one_class_parts_are_an_error(spark, rows):
    with pytest.raises(ValueError, match="validation part has 0 positive"):
        boost.fit_boost(rows, rows.filter(~F.col("y")), COLUMNS, "y", max_trees=2)
    with pytest.raises(ValueError, match="train part has 0 positive and 0 negative"):
        boost.fit_boost(rows.limit(0), rows, COLUMNS, "y", max_trees=2)
