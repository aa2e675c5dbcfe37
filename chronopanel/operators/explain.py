"""Tree attributions (M14): path-dependent Shapley values for Spark tree
ensembles.

The fitted trees are exported once to flat arrays and broadcast (their size is
the model's, not the data's). Tasks read the assembled feature vector and walk
each tree once for a whole Arrow batch. Output is the long attribution table (keys, feature,
feature_value, shap_value, abs_shap, direction, pred, base_value); slots are
named by the vector's ML attributes, so one-hot categories are explained like
any other feature. Additivity holds per row: pred = base_value + sum.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import as_list

__all__ = ["export_trees", "shap_values", "staged_predictions", "expected_value", "tree_shap", "conditional_expectation"]


def export_trees(model, spark: SparkSession | None = None) -> list[dict]:
    """Flatten every tree of a Spark regression tree model / forest / GBT to
    arrays: left, right (-1 at leaves), feature, threshold, value, cover;
    ``weight`` is the tree's weight in the ensemble (1/n for a forest).

    The model is written with Spark ML's own writer to the shared checkpoint
    folder and its node table is read back with one Spark job, so a forest
    of hundreds of deep trees is exported without per-node driver calls. A
    continuous split sends ``x <= threshold`` left; a categorical one (one-hot
    slots) sends the values of ``left_set`` left."""
    import uuid

    from ..session import checkpoint_dir
    spark = spark or SparkSession.getActiveSession()
    path = checkpoint_dir(spark).rstrip("/") + f"/model-export-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(path + "/data")
    if "treeID" not in nodes.columns:
        nodes = nodes.select(F.lit(0).alias("treeID"), F.struct(*nodes.columns).alias("nodeData"))
    rows = nodes.select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
                        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
                        "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories").toPandas()
    n_trees = int(rows["treeID"].max()) + 1
    weights = list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0]
    is_forest = type(model).__name__.startswith("RandomForest")
    out = []
    for tid in range(n_trees):
        t = rows[rows["treeID"] == tid].sort_values("id")
        n = len(t)
        left = t["leftChild"].to_numpy().astype(int)
        right = t["rightChild"].to_numpy().astype(int)
        leaf = left < 0
        feat = np.where(leaf, -1, t["featureIndex"].fillna(-1).to_numpy().astype(int))
        cat = t["numCategories"].fillna(-1).to_numpy() >= 0
        given = [list(v) if v is not None else [] for v in t["leftCategoriesOrThreshold"]]
        thr = np.array([float(v[0]) if v and not c else 0.0 for v, c in zip(given, cat)])
        cover = np.array([float(v[0]) for v in t["impurityStats"]])
        assert (t["id"].to_numpy() == np.arange(n)).all()
        out.append(dict(left=left, right=right, feature=feat, threshold=np.where(leaf, 0.0, thr),
                        left_set=[np.array(v, float) if c and not end else None for v, c, end in zip(given, cat, leaf)],
                        value=t["prediction"].to_numpy().astype(float), cover=cover,
                        weight=(1.0 / n_trees) if is_forest else float(weights[tid])))
    return out


def expected_value(tree: dict) -> float:
    """Cover-weighted mean of the leaf values (the tree's base value)."""
    leaves = tree["left"] < 0
    return float(np.sum(tree["value"][leaves] * tree["cover"][leaves]) / np.sum(tree["cover"][leaves]))


def _left(tree: dict, node: int, v):
    """Do the values go left? NaN goes right, like in Spark."""
    own = tree["left_set"][node] if "left_set" in tree else None
    return np.isin(v, own) if own is not None else v <= tree["threshold"][node]


def shap_values(tree: dict, x: np.ndarray) -> np.ndarray:
    """Shapley values (rows x features) of one tree under its cover
    distribution.

    A leaf is the game v(S) = value * prod(S: o) * prod(not S: z), with o = 1
    where the row meets the feature's conditions on the path and z the product
    of the cover ratios at its splits. Its Shapley value for feature f is
    value * (o_f - z_f) times the integral over t in (0, 1) of the other
    features' prod(o t + z (1 - t)), a polynomial that Gauss-Legendre points
    integrate exactly. The products grow along the paths, so all leaves below
    a node share them: one pass down multiplies them, one pass up adds the
    leaves, and each edge adds its feature's part for its whole subtree (less
    what an earlier edge of the same feature added). The cost is nodes x half
    the depth a row, not leaves x depth squared."""
    phi, n = np.zeros(x.shape), len(x)
    depth = _depth(tree)
    if not depth or not n:
        return phi
    t, w = np.polynomial.legendre.leggauss((depth + 1) // 2)
    t, w = (t + 1) / 2, w / 2
    lift = lambda o, z: o * t + z * (1 - t)

    def below(node, product, seen):
        """Sum over the leaves below of value x product, at every point t.
        ``seen``: feature -> (rows that meet its conditions so far, z)."""
        if tree["left"][node] < 0:
            return tree["value"][node] * product
        f = int(tree["feature"][node])
        met, z = seen.get(f, (None, 1.0))
        left = _left(tree, node, x[:, f])
        total = 0.0
        for child, goes in ((int(tree["left"][node]), left), (int(tree["right"][node]), ~left)):
            zc = z * float(tree["cover"][child] / tree["cover"][node])
            # cases of a row: met before and now, met before only, not met before
            factor = np.stack([lift(1.0, zc), lift(0.0, zc), lift(0.0, zc)])
            part = np.stack([(1.0 - zc) / lift(1.0, zc), -zc / lift(0.0, zc), -zc / lift(0.0, zc)])
            case = np.where(goes, 0, 1)
            if met is not None:
                case[~met] = 2
                was = np.stack([lift(1.0, z), lift(1.0, z), lift(0.0, z)])
                factor = factor / was
                part = part - np.stack([(1.0 - z) / was[0], (1.0 - z) / was[1], -z / was[2]])
            under = below(child, product * factor[case], {**seen, f: (goes if met is None else goes & met, zc)})
            phi[:, f] += np.einsum("nq,nq->n", (part * w)[case], under)
            total = total + under
        return total

    below(0, np.ones((n, len(t))), {})
    return phi


def _depth(tree: dict) -> int:
    depth, level = 0, [0]
    while level := [int(c) for k in level if tree["left"][k] >= 0 for c in (tree["left"][k], tree["right"][k])]:
        depth += 1
    return depth


def staged_predictions(trees: list[dict], x: np.ndarray, n_trees=(), depths=(None,), min_split=(1,)) -> np.ndarray:
    """Weighted sums of the first ``n`` trees (all if none are named), cut
    off at each depth and at nodes of less cover than each ``min_split``:
    (prefixes, depths, min_split, rows), all from one walk through the trees. A
    tree grown from the top down holds its shallower versions."""
    stops = [(d, m) for d in depths for m in min_split]
    prefixes = list(n_trees) or [len(trees)]
    out, total = np.zeros((len(prefixes), len(stops), len(x))), np.zeros((len(stops), len(x)))
    for k, tree in enumerate(trees):
        at, level, open_ = np.zeros(len(x), int), 0, np.ones((len(stops), len(x)), bool)
        value = np.zeros((len(stops), len(x)))
        while True:
            leaf = tree["left"][at] < 0
            for s, (d, m) in enumerate(stops):
                ends = open_[s] & (leaf | (d is not None and level >= d) | (tree["cover"][at] < m))
                value[s][ends] = tree["value"][at[ends]]
                open_[s] &= ~ends
            if not open_.any():
                break
            for node in np.unique(at[~leaf]).tolist():
                here = np.flatnonzero(at == node)
                at[here] = np.where(_left(tree, node, x[here, int(tree["feature"][node])]), tree["left"][node], tree["right"][node])
            level += 1
        total += tree["weight"] * value
        for i, p in enumerate(prefixes):
            if p == k + 1:
                out[i] = total
    return out.reshape(len(prefixes), len(depths), len(min_split), len(x))


def conditional_expectation(tree: dict, x: np.ndarray, S: set) -> float:
    """E[f(x) | x_S] under the tree's cover distribution (brute-force check)."""
    def go(node):
        if tree["left"][node] < 0:
            return tree["value"][node]
        f = tree["feature"][node]
        if f in S:
            return go(tree["left"][node] if _left(tree, node, x[f]) else tree["right"][node])
        lc, rc = tree["left"][node], tree["right"][node]
        return (go(lc) * tree["cover"][lc] + go(rc) * tree["cover"][rc]) / tree["cover"][node]
    return float(go(0))


def slot_names(df: DataFrame, feature_col: str) -> list[str]:
    """Names of the vector's slots from its ML attributes."""
    meta = df.schema[feature_col].metadata.get("ml_attr", {})
    named = {int(a["idx"]): str(a.get("name", f"f_{a['idx']}")) for kind in meta.get("attrs", {}).values() for a in kind}
    return [named.get(i, f"f_{i}") for i in range(int(meta.get("num_attrs", len(named))))]


def tree_shap(model, df: DataFrame, keys, feature_col: str = "features") -> DataFrame:
    """Long attribution rows for every row of ``df``, which holds the assembled
    vector ``feature_col`` and the model's ``prediction``."""
    keys, names = as_list(keys), slot_names(df, feature_col)
    trees = export_trees(model, df.sparkSession)
    # one copy an executor, not one a task
    shared = df.sparkSession.sparkContext.broadcast(trees)
    base = float(sum(t["weight"] * expected_value(t) for t in trees))
    x = df.select(*keys, F.col("prediction").alias("pred"), vector_to_array(feature_col).alias("_x"))
    key_types = dict(x.dtypes)
    schema = ", ".join([f"`{k}` {key_types[k]}" for k in keys] +
                       ["feature string", "feature_value double", "shap_value double", "abs_shap double",
                        "direction string", "pred double", "base_value double"])

    def explain(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            values = np.stack(pdf["_x"].to_numpy()).astype(float)
            phi = sum(t["weight"] * shap_values(t, values) for t in shared.value)
            out = pdf[[*keys, "pred"]].loc[pdf.index.repeat(len(names))].reset_index(drop=True)
            flat = phi.ravel()
            yield out.assign(feature=np.tile(names, len(pdf)), feature_value=values.ravel(), shap_value=flat, abs_shap=np.abs(flat),
                             direction=np.where(flat >= 0, "up", "down"), base_value=base)[
                [*keys, "feature", "feature_value", "shap_value", "abs_shap", "direction", "pred", "base_value"]]
    return x.mapInPandas(explain, schema)


# Python workers must not need this package installed: functions of this
# module travel by value inside the task closures.
def _ship_by_value() -> None:
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
