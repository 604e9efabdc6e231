"""Histogram trees against plain walks and exhaustive search."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting, evaluation as ev, trees
from riskloom.operators.boosting import BoostedTrees, BoostedTreesModel, BoostSettings

FEATURES = ("a", "b", "c", "d", "void")
SHAPE = {"max_rounds": 6, "depth": 3, "bins": 16, "step": 0.3, "min_weight": 1.0, "patience": 30}


@pytest.fixture(scope="module")
def points(spark):
    """Label by a and b; c is null for most of the positives, d is noise, void is always null."""
    r = random.Random(4)
    rows = []
    for i in range(1500):
        a, b = r.gauss(0, 1), float(r.randrange(6))
        y = int((a > 0.4 and b < 3) or r.random() < 0.05)
        c = None if y and r.random() < 0.7 else math.nan if r.random() < 0.1 else r.random()
        rows.append((i, a if r.random() > 0.05 else None, b, c, r.random(), None, y, "train" if i < 1000 else "val"))
    schema = "id long, a double, b double, c double, d double, void double, y int, split string"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


def settings(**changes):
    return BoostSettings(FEATURES, "y", **{"key": "id", **SHAPE, **changes})


@pytest.fixture(scope="module")
def fitted(points):
    return BoostedTrees(settings()).fit(points)


def nodes_of(model):
    return {(r["tree"], r["node"]): r for r in model.nodes.collect()}


def walk(nodes, tree, row):
    at = nodes[tree, 0]
    while at["feature"] >= 0:
        x = row[FEATURES[at["feature"]]]
        unknown = x is None or math.isnan(x)
        left = at["missing_left"] if unknown else x <= at["threshold"]
        at = nodes[tree, at["left"] if left else at["right"]]
    return at


def test_walks_agree_with_following_the_nodes(points, fitted):
    """Packed, by joins, and node by node; every row has a null feature."""
    nodes, rows = nodes_of(fitted), points.collect()
    packed = {r["id"]: r["fraud_probability"] for r in fitted.transform(points).collect()}
    joined = {r["id"]: r["fraud_probability"] for r in fitted.transform_by_joins(points, ["id"]).collect()}
    assert len(packed) == len(joined) == len(rows)
    for row in rows:
        margin = sum(walk(nodes, t, row)["value"] for t in range(fitted.rounds))
        plain = 1 / (1 + math.exp(-margin))
        assert packed[row["id"]] == pytest.approx(plain, abs=1e-12)
        assert joined[row["id"]] == pytest.approx(plain, abs=1e-12)


def test_joined_walk_computes_no_more_than_a_step_per_level(points, fitted):
    """Joins look for no nulls in computed nodes, and the values stand in one row before the trees multiply it."""
    walked = fitted.transform_by_joins(points, ["id"])
    plan = walked._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(CASE" not in plan
    assert plan.count("nanvl(") and plan.index("Generate explode") < plan.index("nanvl(")


def test_joined_walk_of_infinite_and_missing_values(spark):
    """Infinite values pass infinite thresholds; null and NaN go where the split sends them, or are replaced."""
    inf, nan = math.inf, math.nan
    leaf = lambda node, value: (0, node, 1, -1, None, None, -1, -1, None, 1.0, value)
    values = [inf, -inf, 3.0, 1.0, None, nan]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "id int, a double")
    for threshold in (inf, -inf, 2.0):
        for missing_left in (True, False):
            table = [(0, 0, 0, 0, threshold, missing_left, 1, 2, 1.0, 1.0, 0.0), leaf(1, 1.0), leaf(2, 2.0)]
            nodes = spark.createDataFrame(table, trees.NODE_SCHEMA)
            plain = [missing_left if x is None or math.isnan(x) else x <= threshold for x in values]
            replaced = [(0.0 if x is None or math.isnan(x) else x) <= threshold for x in values]
            for made, missing, sides in ((nodes, None, plain), (nodes.drop("missing_left"), 0.0, replaced), (nodes, 0.0, replaced)):
                walked = trees.walk_by_joins(rows, made, ["id"], ["a"], 1, F.col("value"), missing)
                assert {r["id"]: r["total"] for r in walked.collect()} == {i: 1.0 if x else 2.0 for i, x in enumerate(sides)}
            packed = trees.PackedTrees(nodes.toPandas(), 1).margin(np.array([[nan if x is None else x] for x in values]))
            assert list(packed) == [1.0 if x else 2.0 for x in plain]


def test_nulls_follow_a_learnt_direction(points, fitted):
    nodes = fitted.nodes.where("feature = 2").collect()
    assert nodes, "a feature that is null for the positives is used"
    blank, low, high = ([(0, 0.0, 4.0, c, 0.5, None)] for c in (None, -1e9, 1e9))
    schema = "id long, a double, b double, c double, d double, void double"
    score = [
        fitted.transform(points.sparkSession.createDataFrame(x, schema)).first()["fraud_probability"] for x in (blank, low, high)
    ]
    assert score[0] > max(score[1:])
    assert {n["missing_left"] for n in fitted.nodes.where("feature >= 0").collect()} == {True, False}


def test_no_split_below_its_bounds(points):
    for changes in ({"min_gain": 0.1, "min_weight": 5.0}, {"min_gain": 40.0, "min_weight": 1.0}, {"min_gain": 1e9}):
        s = settings(max_rounds=3, depth=4, **changes)
        rows = BoostedTrees(s).fit(points).nodes.toPandas()
        inner = rows[rows["feature"] >= 0]
        assert (inner["gain"] >= s.min_gain).all()
        assert (rows.loc[rows["node"] > 0, "hessian"] >= s.min_weight).all()
        assert len(inner) == 0 if s.min_gain > 1e6 else len(inner) > 0


def brute_split(values, g, h, settings_):
    """Best (gain, threshold, missing side) over all cuts of the values, nulls on either side."""
    total, best = (g.sum(), h.sum()), None
    known = ~np.isnan(values)
    for cut in np.unique(values[known]):
        for missing_left in (True, False):
            left = np.where(known, values <= cut, missing_left)
            sides = (g[left].sum(), h[left].sum()), (g[~left].sum(), h[~left].sum())
            if min(sides[0][1], sides[1][1]) < settings_.min_weight:
                continue
            gain = sum(a * a / (b + settings_.l2) for a, b in sides) - total[0] ** 2 / (total[1] + settings_.l2)
            if gain >= settings_.min_gain and (best is None or gain > best + 1e-9):
                best = gain
    return best


def test_every_split_is_the_best_one(points):
    """All nodes of the first two trees, on gradients of a plain walk, against all cuts of all features."""
    s = settings(max_rounds=2, row_share=1.0, feature_share=1.0, bins=4096, depth=3)
    model = BoostedTrees(s).fit(points)
    nodes = nodes_of(model)
    rows = [r for r in points.where("split = 'train'").collect()]
    y = np.array([r["y"] for r in rows])
    values = {i: np.array([math.nan if r[f] is None else r[f] for r in rows], float) for i, f in enumerate(FEATURES)}
    margin = np.zeros(len(rows))
    for tree in range(2):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, model.weight, 1.0)
        g, h = w * (p - y), w * p * (1 - p)
        reached = {0: np.ones(len(rows), bool)}
        for node in sorted(n for t, n in nodes if t == tree):
            at, here = nodes[tree, node], reached[node]
            assert at["hessian"] == pytest.approx(h[here].sum(), rel=1e-4)
            best = max((b for v in values.values() if (b := brute_split(v[here], g[here], h[here], s)) is not None), default=None)
            if at["feature"] < 0:
                assert at["depth"] == s.depth or best is None
                assert at["value"] == pytest.approx(-s.step * g[here].sum() / (h[here].sum() + s.l2), rel=1e-3, abs=1e-6)
                continue
            assert at["gain"] == pytest.approx(best, rel=1e-3)
            x = values[at["feature"]]
            left = np.where(np.isnan(x), at["missing_left"], x <= at["threshold"])
            reached[at["left"]], reached[at["right"]] = here & left, here & ~left
        margin += [walk(nodes, tree, r)["value"] for r in rows]


def test_best_split_of_sums_against_all_cuts():
    r = np.random.default_rng(5)
    shape = trees.TreeSettings(min_gain=0.01, min_hessian=0.5)
    for _ in range(60):
        g, h = r.integers(-3, 4, 9) * trees.PARTS, r.integers(0, 3, 9) * trees.PARTS
        found, best = trees.best_split(g, h, shape), None
        for cut in range(8):
            for missing_left in (True, False):
                left = np.r_[np.arange(8) <= cut, missing_left]
                (a, b), (c, d) = ((x[left].sum() / trees.PARTS, x[~left].sum() / trees.PARTS) for x in (g, h))
                if min(c, d) >= 0.5:
                    gain = a * a / (c + 1) + b * b / (d + 1) - (a + b) ** 2 / (c + d + 1)
                    best = gain if gain >= 0.01 and (best is None or gain > best) else best
        assert (found is None) == (best is None)
        assert found is None or found[0] == pytest.approx(best)


def test_features_are_drawn_per_tree(points):
    model = BoostedTrees(settings(feature_share=0.4, max_rounds=8, min_gain=0.0, min_weight=0.1)).fit(points)
    used = [
        {r["feature"] for r in model.nodes.where((F.col("tree") == t) & (F.col("feature") >= 0)).collect()} for t in range(8)
    ]
    assert max(map(len, used)) <= 2 and len(set.union(*used)) > 2


def test_rows_are_drawn_per_round():
    keys = np.arange(20_000, dtype=np.int64)
    first, second = trees.drawn(keys, 0, 42, 0.8), trees.drawn(keys, 1, 42, 0.8)
    assert abs(first.mean() - 0.8) < 0.02 and abs((first & second).mean() - 0.64) < 0.02
    assert trees.drawn(keys, 0, 42, 1.0).all()


def same(one, two):
    return one.nodes.exceptAll(two.nodes).count() == 0 and two.nodes.exceptAll(one.nodes).count() == 0


def test_same_trees_in_any_layout(points, fitted):
    assert same(fitted, BoostedTrees(settings()).fit(points.repartition(1)))
    assert same(fitted, BoostedTrees(settings()).fit(points.orderBy("d")))


def test_margins_stored_between_rounds_change_nothing(points, fitted, monkeypatch):
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    again = BoostedTrees(settings()).fit(points)
    one, two = fitted.nodes.orderBy("tree", "node").toPandas(), again.nodes.orderBy("tree", "node").toPandas()
    pd.testing.assert_frame_equal(one, two, check_exact=False)


def test_a_level_is_one_job_and_a_round_has_few(spark, points):
    """A fit of more rounds runs a job per level for each, and one for the scores of every four at most."""
    context, jobs = spark.sparkContext, []
    for rounds in (2, 10):
        context.setJobGroup(f"boost-{rounds}", "")
        model = BoostedTrees(settings(max_rounds=rounds)).fit(points)
        context.setLocalProperty("spark.jobGroup.id", None)
        assert model.rounds == rounds
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"boost-{rounds}")))
    assert 8 <= jobs[1] - jobs[0] <= 8 * SHAPE["depth"] + 3


def test_nothing_stays_persisted(spark, points):
    held = lambda: set(spark.sparkContext._jsc.getPersistentRDDs())
    before = held()
    BoostedTrees(settings()).fit(points)
    assert held() <= before


def test_sums_that_meet_per_feature_give_the_same_trees(points, fitted, monkeypatch):
    monkeypatch.setattr(trees, "SUMS_AT_ONCE", 0)
    assert same(fitted, BoostedTrees(settings()).fit(points))


def test_scores_do_not_depend_on_ranges_or_blocks(points, fitted, monkeypatch):
    """Many ranges with cuts of few rows, and rows dealt in small blocks to many tasks."""
    for name, value in {"RANGE_ROWS": 40, "CUT_ROWS": 10, "DEALT_ROWS": 64, "BLOCK_ROWS": 100, "TASK_ROWS": 150}.items():
        monkeypatch.setattr(boosting, name, value)
    again = BoostedTrees(settings()).fit(points)
    assert same(fitted, again)
    one, two = (m.curve.orderBy("round").toPandas() for m in (fitted, again))
    pd.testing.assert_frame_equal(one, two, check_exact=False, rtol=1e-12)


@pytest.mark.parametrize("patience", [0, 1, 3, 5])
def test_the_last_round_is_the_first_past_patience(points, patience):
    """The rounds scored together end where scoring each round would have ended."""
    model = BoostedTrees(settings(max_rounds=14, patience=patience, step=0.9)).fit(points)
    found = [r["val_auc"] for r in model.curve.orderBy("round").collect()]
    best, last = 0, 13
    for number, score in enumerate(found):
        best = number if score > max([-1.0, *found[:number]]) else best
        if number - best >= patience:
            last = number
            break
    assert len(found) == last + 1 and model.best_round == best and model.rounds == len(found)


def test_children_summed_as_the_rest_of_their_parent():
    """A tree by a job per level, its larger children by subtraction, against sums of all rows of each node."""
    r = np.random.default_rng(8)
    bins, width = r.integers(0, 9, (3, 400)).astype(np.int16), 9
    g, h = (r.integers(-5, 6, 400) * trees.PARTS).astype(float), (r.integers(1, 3, 400) * trees.PARTS).astype(float)

    class Rows:
        def __init__(self, made):
            self.made = made

        def getNumPartitions(self):
            return len(self.made)

        def mapPartitions(self, f):
            return Rows([list(f(iter(x))) for x in self.made])

        def collect(self):
            return [x for part in self.made for x in part]

    shape = trees.TreeSettings(depth=4, min_gain=0.01, min_hessian=1.0)
    tree = trees.grow(Rows([[(bins[:, :250], g[:250], h[:250])], [], [(bins[:, 250:], g[250:], h[250:])]]), (0, 2, 5), width - 1, shape)
    slots = {0: 0, 2: 1, 5: 2}
    split = 0
    for level in range(4):
        at = tree.route(bins, width - 1, level, (0, 2, 5))
        for node in range(2**level - 1, 2 ** (level + 1) - 1):
            here = at == node
            if not here.any():
                continue
            sums = [np.stack([np.bincount(b[here], x[here], width) for b in bins]).astype(np.int64) for x in (g, h)]
            best = trees.best_splits(*sums, shape)
            assert (best is None) == (tree.feature[node] == trees.LEAF)
            if best:
                split += 1
                assert best[0] == slots[int(tree.feature[node])] and best[1:4] == (tree.gain[node], tree.bin[node], tree.missing_left[node])
    assert split > 8


def test_bin_ends_are_the_percentiles_of_the_known_values(spark, points):
    """Features are cut in tasks of their own; nulls, NaN, repeated, infinite and no values."""
    names = ["a", "b", "c", "d", "void", "far"]
    far = F.when(F.col("id") % 3 == 0, math.inf).when(F.col("id") % 3 == 1, -math.inf)
    known = points.withColumn("far", far).select(*[F.nanvl(F.col(n).cast("double"), F.lit(None)).alias(n) for n in names])
    for bins, rows in ((2, 5000), (16, 5000), (256, 5000), (16, 500)):
        drawn = known
        if rows < 1500:
            drawn = known.where(F.pmod(F.xxhash64(*names), F.lit(1 << 32)) < int(rows / 1500 * (1 << 32)))
        shares = [*[i / bins for i in range(1, bins)], 1.0]
        plain = drawn.agg(*[F.percentile(F.col(n), shares).alias(n) for n in names]).first()
        for name, ends in zip(names, trees.bin_ends(known, names, bins, rows)):
            expected = np.unique(np.array(plain[name] or [math.inf], float))
            assert list(ends[:-1]) == list(expected[:-1]) and ends[-1] == math.inf


def test_bin_ends_meet_per_feature(spark, points, monkeypatch):
    """No task gets the values of all features."""
    frame = points.select(F.col("a"), F.col("b"), F.col("d"))
    plans, kept = [], type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda self: plans.append(self._jdf.queryExecution().toString()) or kept(self))
    trees.bin_ends(frame, ["a", "b", "d"], 8)
    assert any("feature" in p and "RepartitionByExpression [feature" in p for p in plans)
    assert not any("percentile" in p for p in plans)


def test_curve_is_exact(points, fitted):
    """AUC and loss of every round against the evaluation operators."""
    nodes = fitted.nodes.toPandas()
    for number in (0, 3, 5):
        part = BoostedTreesModel(
            fitted.settings, points.sparkSession.createDataFrame(nodes[nodes["tree"] <= number].astype(object).where(lambda x: x.notna(), None), trees.NODE_SCHEMA), 1.0, number + 1, 0, None
        )
        line = fitted.curve.where(F.col("round") == number).first()
        scored = part.transform(points)
        for name in ("train", "val"):
            rows = scored.where(F.col("split") == name)
            assert ev.roc_auc(ev.score_curve(rows, "y", "fraud_probability")).first()[0] == pytest.approx(line[f"{name}_auc"])
            assert ev.log_loss(rows, "y", "fraud_probability").first()[0] == pytest.approx(line[f"{name}_loss"])
    falling = [r["objective"] for r in fitted.curve.orderBy("round").collect()]
    assert falling == sorted(falling, reverse=True)


def test_pairs_won_beyond_64_bits():
    big = 4 * 10**9
    pos, neg = np.array([big, big]), np.array([big, big])
    assert boosting._won(pos, neg, 0) == big * big + big * (2 * big + big)


def test_store(spark, points, fitted, tmp_path):
    fitted.save(str(tmp_path / "b"))
    back = BoostedTreesModel.load(spark, str(tmp_path / "b"))
    assert back.settings == fitted.settings and (back.rounds, back.best_round) == (fitted.rounds, fitted.best_round)
    assert same(fitted, back) and back.curve.exceptAll(fitted.curve).count() == 0


def test_odd_tables(spark, points):
    one_class = points.where("y = 0 or split = 'val'")
    with pytest.raises(ValueError):
        BoostedTrees(settings()).fit(one_class)
    unlabelled = points.withColumn("y", F.when(F.col("id") % 3 != 0, F.col("y")))
    model = BoostedTrees(settings(max_rounds=2)).fit(unlabelled)
    assert model.transform(unlabelled).count() == points.count()
    no_val = BoostedTrees(settings(max_rounds=2)).fit(points.where("split = 'train'"))
    assert [r["val_auc"] for r in no_val.curve.collect()] == [None, None]
    assert model.transform(points.limit(0)).count() == 0 and model.transform_by_joins(points.limit(0), ["id"]).count() == 0


def test_constant_and_infinite_values(spark):
    rows = [(i, 1.0, math.inf if i % 2 else -math.inf, i % 2, "train" if i < 60 else "val") for i in range(90)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int, split string")
    model = BoostedTrees(BoostSettings(("a", "b"), "y", key="id", max_rounds=3, min_weight=0.5, step=0.5, row_share=1.0, feature_share=1.0)).fit(df)
    scores = {r["y"]: r["fraud_probability"] for r in model.transform(df).collect()}
    assert scores[1] > 0.6 and scores[0] < 0.4
