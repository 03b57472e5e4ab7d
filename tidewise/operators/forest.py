"""Random forests of deep trees (J7) as a ``pyspark.ml`` stage.

MLlib grows all trees together, some nodes a job, and ships the trees so far with every task, so a
hundred trees of thirty levels on all features do not end.  Here the features are cut once into at
most ``maxBins`` bins, as MLlib cuts them, and a tree is one task: the rows are drawn with Poisson
counts, and each level sorts its rows by (node, bin) for every feature, so that it costs in proportion to
the rows however many nodes are open.  Splits are MLlib's: largest fall of the variance, at least
``minInstancesPerNode`` drawn rows in a child, a gain of at least ``minInfoGain`` and above rounding.

The trees stay a distributed table; predictions add them up, ``CHUNK_BYTES`` at a time.  Rows beyond
``FOREST_BYTES`` when binned go to MLlib.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._col import qident
from ..session import cut_lineage
from .boost import Tree, _blocks, _unpacked, binned, to_bins
from .quantiles import frequency_table, quantile_values

#: Binned rows (bytes) up to which a tree grows in one task.
FOREST_BYTES = 64 << 20
#: Trees (bytes) that a task holds while it predicts.
CHUNK_BYTES = 64 << 20


# --- bins ---------------------------------------------------------------------

def split_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Of each feature: the middles between its values where there are ``max_bins`` at most, else quantiles."""
    seen = cut_lineage(frequency_table(df, features))
    few = [r["key"] for r in seen.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= max_bins).collect()]
    values: dict[int, list[float]] = {}
    for r in seen.where(F.col("key").isin(few)).select("key", "x").collect():
        values.setdefault(r["key"], []).append(r["x"])
    probs = [k / max_bins for k in range(1, max_bins)]
    many = [c for k, c in enumerate(features) if k not in values]
    found = quantile_values(df, many, probs)
    out = []
    for k, c in enumerate(features):
        if k in values:
            own = np.sort(values[k])
            out.append((own[1:] + own[:-1]) / 2)
        else:
            out.append(np.unique([found[c, p] for p in probs if found[c, p] is not None]).astype(float))
    return out


# --- one tree -----------------------------------------------------------------

def best_cuts(columns: np.ndarray, node: np.ndarray, weight: np.ndarray, value: np.ndarray, nodes: int, least: float) -> tuple[np.ndarray, ...]:
    """Of each node: fall of its variance by the best split (-inf: none), feature, bin, sum and weight of its rows."""
    total_w, total_s = np.bincount(node, weight, nodes), np.bincount(node, weight * value, nodes)
    best, feature, cut = np.full(nodes, -np.inf), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    at, width = np.arange(len(node)), int(columns.max(initial=0)) + 1
    shift = max(int(len(node)).bit_length(), 1)
    for k, own in enumerate(columns):
        order = np.sort(((node * width + own) << shift) | at)
        cell, order = order >> shift, order & ((1 << shift) - 1)
        w = weight[order]
        sums, counts = np.cumsum(w * value[order]), np.cumsum(w)
        last = np.flatnonzero(np.append(cell[1:] != cell[:-1], True))  # the last row of each (node, bin)
        of, sums, counts, cell = cell[last] // width, sums[last], counts[last], cell[last]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        size = np.diff(np.append(first, len(of)))
        left_s = sums - np.repeat(np.append(0.0, sums)[first], size)
        left_w = counts - np.repeat(np.append(0.0, counts)[first], size)
        s, n = total_s[of], total_w[of]
        right_w = n - left_w
        ok = (left_w >= least) & (right_w >= least) & (right_w > 0.5)
        gain = np.full(len(of), -np.inf)
        gain[ok] = (left_s[ok] ** 2 / left_w[ok] + (s - left_s)[ok] ** 2 / right_w[ok] - s[ok] ** 2 / n[ok]) / n[ok]
        found = np.maximum.reduceat(gain, first)
        hit = np.flatnonzero(gain == np.repeat(found, size))
        hit = hit[np.append(True, of[hit][1:] != of[hit][:-1])]  # of equal gains the lowest bin's
        open_ = of[first]
        better = found > best[open_]  # of equal gains the first feature's
        now = open_[better]
        best[now], feature[now], cut[now] = found[better], k, cell[hit][better] % width
    return best, feature, cut, total_s, total_w


def grow_tree(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int, least: float, least_gain: float) -> Tree:
    """A tree on rows (columns of ``bins``) that count ``weight`` times."""
    use = np.flatnonzero(weight)
    columns, w = bins[:, use], weight[use].astype(float)
    middle = float(np.average(y[use], weights=w)) if len(use) else 0.0
    v = y[use] - middle  # small sums keep their digits
    noise = 1e-9 * float(np.average(v * v, weights=w)) if len(use) else 0.0
    node, count = np.zeros(len(use), np.int64), 1
    features, cuts, values = [], [], []
    for level in range(depth + 1):
        if not len(node):  # no row was drawn
            features.append(np.full(1, -1, np.int8)), cuts.append(np.zeros(1, np.uint8)), values.append(np.full(1, middle))
            break
        if level < depth:
            gain, f, cut, sums, counts = best_cuts(columns, node, w, v, count, least)
            split = (gain > noise) & (gain >= least_gain)
        else:
            f = cut = np.zeros(count, np.int64)
            sums, counts, split = np.bincount(node, w * v, count), np.bincount(node, w, count), np.zeros(count, bool)
        features.append(np.where(split, f, -1).astype(np.int8))
        cuts.append(np.where(split, cut, 0).astype(np.uint8))
        values.append(middle + sums / counts)
        if not split.any():
            break
        stay = np.flatnonzero(split[node])
        columns, node, w, v = columns[:, stay], node[stay], w[stay], v[stay]
        right = columns[f[node], np.arange(len(node))] > cut[node]
        node, count = 2 * (np.cumsum(split) - 1)[node] + right, 2 * int(split.sum())
    return tree_of(np.concatenate(features), np.concatenate(cuts), np.concatenate(values))


def tree_of(feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> Tree:
    """Level by level the children of the j-th split are the nodes 2j + 1 and 2j + 2."""
    return Tree(feature.astype(np.int32), cut.astype(np.int32), 2 * np.cumsum(feature >= 0) - 1, value)


def packed(tree: Tree) -> bytes:
    leaf = tree.feature < 0
    return b"".join([np.int64(len(leaf)).tobytes(), tree.feature.astype(np.int8).tobytes(), tree.cut.astype(np.uint8).tobytes(), tree.value[leaf].tobytes()])


def unpacked(data: bytes) -> Tree:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    feature, cut = np.frombuffer(data, np.int8, n, 8), np.frombuffer(data, np.uint8, n, 8 + n)
    value = np.zeros(n)
    value[feature < 0] = np.frombuffer(data, float, -1, 8 + 2 * n)
    return tree_of(feature, cut, value)


def _scorer(shared: Broadcast, edges: list[np.ndarray]) -> Callable:
    """The sum of the trees' predictions for arrays of features."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            total = np.zeros(len(x))
            if len(x):
                bins = to_bins(np.stack(x.to_numpy()).astype(float), edges)
                for one in shared.value:
                    tree = unpacked(one)
                    total += tree.value[tree.place(bins)]
            yield pd.Series(total)

    return score


# --- the stages -----------------------------------------------------------------

class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", typeConverter=TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", typeConverter=TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature (2 to 256)", typeConverter=TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least drawn rows in a child", typeConverter=TypeConverters.toInt)
    minInfoGain = Param(Params._dummy(), "minInfoGain", "least fall of the variance", typeConverter=TypeConverters.toFloat)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "features at a split: all", typeConverter=TypeConverters.toString)

    def _defaults(self):
        self._setDefault(numTrees=20, maxDepth=5, maxBins=32, minInstancesPerNode=1, minInfoGain=0.0, featureSubsetStrategy="all", seed=42)


class Forest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """MLlib's ``RandomForestRegressor`` with every feature at every split, a tree a task."""

    OWN = ("numTrees", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "featureSubsetStrategy", "seed")

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", numTrees=20, maxDepth=5, maxBins=32,
                 minInstancesPerNode=1, minInfoGain=0.0, featureSubsetStrategy="all", seed=42):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    @classmethod
    def takes(cls, params: dict) -> bool:
        return set(params) <= set(cls.OWN) and params.get("featureSubsetStrategy") == "all" and 2 <= params.get("maxBins", 32) <= 256

    def _fit(self, df: DataFrame) -> Model:
        own = {p: self.getOrDefault(p) for p in self.OWN}
        spark, label = df.sparkSession, F.col(qident(self.getLabelCol())).cast("double")
        data = cut_lineage(df.select(vector_to_array(F.col(qident(self.getFeaturesCol()))).alias("x"), label.alias("y")))
        n, width = data.agg(F.count("y"), F.max(F.size("x"))).first()
        if not n:
            raise ValueError("no row to fit a forest on")
        if n * (width + 8) > FOREST_BYTES or width > 127:
            cols = {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol(), "predictionCol": self.getPredictionCol()}
            return RandomForestRegressor(**cols, **own).fit(df)
        names = [f"f{k}" for k in range(width)]
        flat = data.select(F.lit(0).alias("key"), "y", *[F.col("x")[k].alias(c) for k, c in enumerate(names)])
        edges = split_edges(flat.where("y IS NOT NULL"), names, own["maxBins"])
        # sorted, so that the draws don't depend on the order in which rows arrive
        rows = binned(flat, names, ["y"], "key", edges).sort("bins", "y")
        _, bins, y = _unpacked(_blocks(rows).collect(), width)
        held = spark.sparkContext.broadcast((np.ascontiguousarray(bins.T), y[:, 0].copy()))  # bounded by the check above

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            columns, y = held.value
            for batch in batches:
                for k in batch["tree"]:
                    weight = np.random.default_rng([own["seed"] & 0xFFFFFFFFFFFFFFFF, int(k)]).poisson(1.0, len(y)).astype(np.uint8)
                    tree = grow_tree(columns, y, weight, own["maxDepth"], own["minInstancesPerNode"], own["minInfoGain"])
                    yield pd.DataFrame({"tree": [k], "data": [packed(tree)]})

        work = spark.range(own["numTrees"]).select(F.col("id").cast("int").alias("tree"))
        trees = cut_lineage(work.repartitionById(own["numTrees"], F.col("tree")).mapInPandas(run, "tree int, data binary"))
        held.destroy()
        model = ForestModel()
        model._set(**{p.name: v for p, v in self.extractParamMap().items()})
        model.trees, model.edges = trees, edges
        return model


class ForestModel(Model, _ForestParams, MLWritable, MLReadable):
    """The fitted trees: ``trees`` (tree, data) as a table, the edges of the bins on the driver."""

    trees: DataFrame
    edges: list[np.ndarray]

    def __init__(self):
        super().__init__()
        self._defaults()

    def _transform(self, df: DataFrame) -> DataFrame:
        sizes = sorted(self.trees.select("tree", F.length("data").alias("n")).collect())
        chunks: list[list[int]] = []
        held = 0
        for tree, n in sizes:
            if not chunks or held + n > CHUNK_BYTES:
                chunks.append([])
                held = 0
            chunks[-1].append(tree)
            held += n
        name, edges = self.getPredictionCol(), self.edges
        out = df.withColumn(name, F.lit(0.0))
        for k, chunk in enumerate(chunks):
            data = [bytes(r["data"]) for r in self.trees.where(F.col("tree").isin(chunk)).orderBy("tree").collect()]
            shared = df.sparkSession.sparkContext.broadcast(data)
            out = out.withColumn(name, F.col(qident(name)) + _scorer(shared, edges)(vector_to_array(F.col(qident(self.getFeaturesCol())))))
            if k < len(chunks) - 1:  # the trees of one chunk at a time
                out = cut_lineage(out)
                shared.destroy()
        return out.withColumn(name, F.col(qident(name)) / F.lit(float(len(sizes))))

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        self.model.trees.write.parquet(f"{path}/trees")
        spark.createDataFrame([(k, e.tolist()) for k, e in enumerate(self.model.edges)], "k int, edges array<double>").write.parquet(f"{path}/edges")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = ForestModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.trees = spark.read.parquet(f"{path}/trees")
        model.edges = [np.array(r["edges"], float) for r in spark.read.parquet(f"{path}/edges").orderBy("k").collect()]
        return model
