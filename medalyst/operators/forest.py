"""Isolation forest per group, trained and scored as grouped Spark jobs of bounded size.

Each (group, tree) trains on a hash sample of about ``sample_rows`` rows. Forests of up to ``BROADCAST_BYTES`` together go to the rows,
which are scored where they are. Beyond that size scoring cuts every group into chunks of about ``chunk_rows`` rows and joins each chunk
with its group's trees, so a task never holds more than one chunk and one forest.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.operators.quantiles import exact_quantiles, quantile_struct
from medalyst.operators.relational import null_safe_join
from medalyst.session import durable

# workers get these helpers with the task, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_BYTES, BROADCAST_BYTES = 64, 64 << 20      # of a node in a worker's memory, and of all forests that may be sent to every executor
EULER = 0.5772156649015329


def _average_path(n):
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    usual = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, usual))


def _grow(rows: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes as (feature, split, left, right, leaf length); feature -1 marks a leaf."""
    nodes: list = []

    def add(sub: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(None)
        spread = sub.max(axis=0) - sub.min(axis=0) if len(sub) else np.zeros(rows.shape[1])
        open_features = np.flatnonzero(spread > 0)
        if depth >= max_depth or len(sub) <= 1 or not len(open_features):
            nodes[at] = (-1, 0.0, -1, -1, float(depth + _average_path(len(sub))))
            return at
        f = int(rng.choice(open_features))
        split = float(rng.uniform(sub[:, f].min(), sub[:, f].max()))
        left = sub[:, f] <= split
        nodes[at] = (f, split, add(sub[left], depth + 1), add(sub[~left], depth + 1), 0.0)
        return at

    add(rows, 0)
    return nodes


def _path_lengths(x: np.ndarray, tree: pd.DataFrame) -> np.ndarray:
    feature, split = tree["feature"].to_numpy(), tree["split"].to_numpy()
    left, right, length = tree["left"].to_numpy(), tree["right"].to_numpy(), tree["length"].to_numpy()
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return length[at]
        goes_left = x[np.arange(len(x)), np.maximum(f, 0)] <= split[at]
        at = np.where(inner, np.where(goes_left, left[at], right[at]), at)


def _filled(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """``rows`` with missing features as their group's median, then the table's, then 0."""
    rows = rows.withColumns({f: F.nanvl(f, F.lit(None).cast("double")) for f in features})
    missing = rows.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in features]).first()
    for f in features:
        if missing[f]:
            overall = F.coalesce(quantile_struct(rows, f, {"m": 0.5})["m"], F.lit(0.0))
            medians = exact_quantiles(rows, f, {"_median": 0.5}, keys=["_g"])
            rows = null_safe_join(rows, medians, ["_g"], "left").withColumn(f, F.coalesce(f, "_median", overall)).drop("_median")
    return rows


def anomaly_scores(df: DataFrame, group: str, key: str, features: Sequence[str], trees: int = 100,
                   sample_rows: int = 256, chunk_rows: int = 1_000_000, seed: int = 42) -> DataFrame:
    """``key``, ``group`` and ``score`` (higher is more normal, like 0.5 minus the usual anomaly score) for every row.

    Missing features are filled with the median of their group; rows without a group form a group.
    """
    rows = _filled(df.select(key, F.col(group).cast("string").alias("_g"), *[F.col(f).cast("double").alias(f) for f in features]), features)
    sizes = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    sized = null_safe_join(rows, sizes, ["_g"])

    # hash sampling in two steps: thin the group once, then pick trees for the survivors
    unit = lambda *c: F.pmod(F.xxhash64(*c, F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    thin = F.least(F.lit(1.0), F.lit(float(trees * sample_rows)) / F.col("_n"))
    per_tree = F.least(F.lit(1.0), F.lit(float(sample_rows)) / (F.col("_n") * thin))
    drawn = (sized.where(unit(F.lit("thin"), F.col(key)) < thin).withColumn("_rate", per_tree)
             .withColumn("_tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
             .where(unit(F.lit("tree"), F.col(key), F.col("_tree")) < F.col("_rate")))
    depth = int(np.ceil(np.log2(sample_rows)))
    names = list(features)

    def train(keys: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        g, t = keys
        ordered = pdf.sort_values(key)[names].to_numpy(dtype=float)
        nodes = _grow(ordered, np.random.default_rng([seed, int(t)]), depth)
        out = pd.DataFrame(nodes, columns=["feature", "split", "left", "right", "length"])
        out.insert(0, "node", range(len(out)))
        out.insert(0, "_tree", int(t))
        out.insert(0, "_g", g)
        out["drawn"] = len(ordered)
        return out

    forest = drawn.groupBy("_g", "_tree").applyInPandas(
        train, "_g string, _tree int, node int, feature int, split double, left int, right int, length double, drawn int")

    key_type = df.schema[key].dataType.simpleString()
    output = f"{key} {key_type}, _g string, score double"

    def grove_scores(x: np.ndarray, grown: list[pd.DataFrame]) -> np.ndarray:
        mean = sum(_path_lengths(x, t) for t in grown) / len(grown)
        usual = float(_average_path(np.mean([t["drawn"].iloc[0] for t in grown])))
        return 0.5 - np.exp2(-mean / usual) if usual > 0 else np.zeros(len(x))

    spark = df.sparkSession
    forest = durable(forest)
    if forest.count() * NODE_BYTES <= BROADCAST_BYTES:
        # the trees go to the rows: no row is shuffled to be scored
        nodes = forest.toPandas()
        held: dict = {}
        for row in nodes.itertuples(index=False):
            held.setdefault(None if pd.isna(row[0]) else row[0], []).append(row)
        groves = spark.sparkContext.broadcast({
            g: [t.sort_values("node") for _, t in pd.DataFrame(part, columns=nodes.columns).groupby("_tree")] for g, part in held.items()})

        def in_place(batches):
            for part in batches:
                part["score"] = 0.0                                     # where no tree drew a row of the group
                for g in part["_g"].unique():
                    at = part["_g"].isna() if pd.isna(g) else part["_g"] == g
                    grown = groves.value.get(None if pd.isna(g) else g)
                    if grown:
                        part.loc[at, "score"] = grove_scores(part.loc[at, names].to_numpy(dtype=float), grown)
                yield part[[key, "_g", "score"]]

        scored = rows.select(key, "_g", *names).mapInPandas(in_place, output)
        return durable(scored.withColumnRenamed("_g", group))

    chunks = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(chunk_rows))).cast("int")
    chunked = sized.withColumn("_chunk", F.pmod(F.xxhash64(F.lit("chunk"), F.col(key)), chunks).cast("int"))
    copies = null_safe_join(forest, sizes, ["_g"]).withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).drop("_n")

    def score(_: tuple, part: pd.DataFrame, grove: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame({key: [], "_g": [], "score": []})
        if grove.empty:                                    # no tree drew a row
            return pd.DataFrame({key: part[key], "_g": part["_g"], "score": 0.0})
        return pd.DataFrame({key: part[key], "_g": part["_g"],
                             "score": grove_scores(part[names].to_numpy(dtype=float), [t.sort_values("node") for _, t in grove.groupby("_tree")])})

    scored = chunked.groupBy("_g", "_chunk").cogroup(copies.groupBy("_g", "_chunk")).applyInPandas(score, output)
    # scores are read several times downstream and must not be trained again each time
    return durable(scored.withColumnRenamed("_g", group))


def flagged_anomalies(scores: DataFrame, group: str, contamination: float = 0.10, min_rows: int = 10) -> DataFrame:
    """Flag the lowest share of scores in each group and rescale scores to a 0..1 probability.

    ``enough`` tells whether a group has ``min_rows`` rows; in a smaller one nothing is flagged, and scores and probabilities stay as they are.
    """
    limit = exact_quantiles(scores, "score", {"_limit": contamination}, keys=[group])
    span = scores.groupBy(group).agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    joined = null_safe_join(null_safe_join(scores, span, [group]), limit, [group])
    enough = F.col("_n") >= min_rows
    prob = F.lit(1.0) - F.try_divide(F.col("score") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return joined.withColumns({
        "anomaly_flag": (enough & (F.col("score") < F.col("_limit"))).cast("int"),
        "anomaly_probability": F.coalesce(prob, F.lit(0.0)), "anomaly_score": F.col("score"), "enough": enough}).drop("_lo", "_hi", "_n", "_limit", "score")
