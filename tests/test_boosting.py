"""Rounds of boosting: samples, margins, metrics, tree tables and thresholds."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trailfeat.operators import boosting as B
from trailfeat.operators import evaluate as EV
from trailfeat.operators import model as M
from trailfeat.operators import trees as TR
from trailfeat.operators.features import feature_matrix, ml_feature_names, ml_table
from trailfeat.operators.parse import good, parse_trajectories
from trailfeat.operators.sampling import in_sample, sampled_columns
from trailfeat.sources import events as E


@pytest.fixture(scope="module")
def features(spark):
    return feature_matrix(good(parse_trajectories(E.trajectory_lines(spark, SF_SMALL)))).cache()


@pytest.fixture(scope="module")
def model(features):
    return M.fit(features, rounds=4, max_depth=3)


def test_samples_do_not_depend_on_partitions(spark):
    ids = spark.range(5000).select(F.concat(F.lit("t"), F.col("id")).alias("traj_id"))
    one, many = ({r[0] for r in ids.repartition(n).where(in_sample(F.col("traj_id"), 0.3, 2)).collect()} for n in (1, 211))
    assert one == many and 1300 < len(one) < 1700
    other = {r[0] for r in ids.where(in_sample(F.col("traj_id"), 0.3, 3)).collect()}
    assert len(one & other) < 0.5 * len(one)  # each round has its own sample
    whole, none = (ids.where(in_sample(F.col("traj_id"), share)).count() for share in (1.0, 0.0))
    assert (whole, none) == (5000, 0)
    names = [f"f{i}" for i in range(40)]
    assert len(sampled_columns(names, 0.5, 1)) == 20 and sampled_columns(names, 0.5, 1) != sampled_columns(names, 0.5, 2)
    assert sampled_columns(names, 1.0) == list(range(40)) and len(sampled_columns(names, 0.001)) == 1


def test_all_rows_and_columns_give_the_margins_of_the_trainer(features, model):
    own = B.fit_rounds(features, rounds=4, max_depth=3)
    assert own.weights == pytest.approx(list(model.treeWeights))
    a, b = ({r.traj_id: r.margins for r in B.staged_margins(m, features).collect()} for m in (own, B.as_boosted(model)))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-9) for k in a)
    score = {r.traj_id: (r.score, r.prediction) for r in M.predict(model, features).collect()}
    mine = {r.traj_id: (r.score, r.prediction) for r in B.predict(own, features).collect()}
    assert all(mine[k] == pytest.approx(score[k], abs=1e-9) for k in score)


def test_sampled_rounds_are_the_same_under_any_partitioning(features):
    kw = dict(rounds=3, max_depth=3, row_share=0.6, column_share=0.3)
    a, b = (B.fit_rounds(features.repartition(n), **kw) for n in (1, 17))
    assert a.columns == b.columns and len(a.columns[0]) == round(0.3 * len(ml_feature_names(features.columns)))
    x, y = ({r.traj_id: r.margins for r in B.staged_margins(m, features).collect()} for m in (a, b))
    assert all(np.allclose(x[k], y[k], atol=1e-9) for k in x)


def test_metrics_of_every_round(features, model):
    train, rest = B.held_out(features, 0.3)
    assert train.count() + rest.count() == features.count() and rest.count() > 10
    boosted = B.as_boosted(model)
    got = {r["round"]: r for r in B.round_metrics(boosted, rest).collect()}
    rows = B.staged_margins(boosted, rest, keep=("label",)).collect()
    y = np.array([float(r.label) for r in rows])
    margins = np.array([r.margins for r in rows])
    assert set(got) == {1, 2, 3, 4}
    for k in got:
        m = margins[:, k - 1]
        loss = np.log1p(np.exp(-2 * (2 * y - 1) * m)).mean()
        pairs = [(a > b) + 0.5 * (a == b) for a in m[y == 1] for b in m[y == 0]]
        assert got[k]["n"] == len(y) and got[k]["logloss"] == pytest.approx(loss) and got[k]["auc"] == pytest.approx(np.mean(pairs))
    best = B.best_round(B.round_metrics(boosted, rest))
    assert got[best]["logloss"] == min(r["logloss"] for r in got.values())
    assert len(B.first_rounds(boosted, best).trees) == best


def test_early_stop_waits_for_its_patience(spark):
    losses = spark.createDataFrame([(1, 0.9), (2, 0.7), (3, 0.8), (4, 0.75), (5, 0.6)], "round long, logloss double")
    assert [B.best_round(losses, p) for p in (None, 1, 2, 3)] == [5, 2, 2, 5]
    assert B.best_round(losses.limit(0)) == 0


def test_tree_table_agrees_with_the_model(spark, features, model, tmp_path):
    path = str(tmp_path / "model")
    model.write().save(path)
    names = ml_feature_names(features.columns)
    nodes = TR.tree_nodes(spark, path, names).cache()
    assert nodes.count() == model.totalNumNodes and nodes.select("tree").distinct().count() == len(model.trees)
    assert [r.tree_weight for r in nodes.where("node = 0").orderBy("tree").collect()] == pytest.approx(list(model.treeWeights))
    inner = nodes.where("feature is not null").alias("p")
    kids = nodes.alias("c")
    both = inner.join(kids, (F.col("p.tree") == F.col("c.tree")) & ((F.col("c.node") == F.col("p.left")) | (F.col("c.node") == F.col("p.right"))))
    assert both.count() == 2 * inner.count()
    cover = both.groupBy("p.tree", "p.node").agg(F.first("p.cover").alias("own"), F.sum("c.cover").alias("kids")).collect()
    assert all(r.own == pytest.approx(r.kids) for r in cover)
    want = dict(zip(names, model.featureImportances.toArray()))
    got = {r.feature: r.importance for r in TR.feature_weights(nodes).collect()}
    assert all(got.get(n, 0.0) == pytest.approx(w, abs=1e-9) for n, w in want.items())


def test_thresholds_from_a_histogram(spark):
    rng = np.random.default_rng(6)
    scores, truth = rng.beta(2, 1, 4000), rng.integers(0, 2, 4000)
    df = spark.createDataFrame([(float(s), float(t)) for s, t in zip(scores, truth)] + [(None, 1.0)], "score double, label double")
    whole = EV.score_histogram(df, bins=100)
    parts = [EV.score_histogram(p, bins=100) for p in df.randomSplit([0.5, 0.5], 3)]
    added = parts[0].unionByName(parts[1]).groupBy("bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, added.collect()))  # histograms of parts add up
    curve = EV.threshold_curve(whole, 100)
    for r in curve.collect():
        flagged = scores < r.threshold
        assert r.flagged == flagged.sum() and r.tpr == pytest.approx((flagged & (truth == 0)).sum() / (truth == 0).sum())
        assert r.fpr == pytest.approx((flagged & (truth == 1)).sum() / (truth == 1).sum())
        assert r.precision == pytest.approx((truth[flagged] == 0).mean())
    widest = np.bincount((scores * 100).astype(int)).max() / len(scores)
    for share in (0.0, 0.1, 0.5, 1.0):
        t = EV.threshold_for_share(curve, share).first()["threshold"]
        assert (scores < t).mean() <= share and share - (scores < t).mean() <= widest  # off by one bin at most
    assert EV.threshold_for_share(EV.threshold_curve(whole.limit(0)), 0.5).first()["threshold"] == 0.0


def test_trainer_takes_its_own_sampling(features):
    assert M.gbt(subsample=0.5, column_subset="sqrt").getSubsamplingRate() == 0.5
    assert M.fit(features, rounds=2, max_depth=2, subsample=0.5, column_subset="onethird").getNumTrees == 2
    assert ml_table(features).columns[-1] == "features"
