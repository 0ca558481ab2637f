"""One classifier per cell: training, evaluation, assignment.

Features are categorical, so a prediction is a function of the distinct feature
tuple. Models are trained on tuples with their counts as weights and applied to
the distinct tuples of the rows to assign; rows only take part in the joins.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segloom.config import (
    AXES,
    CELL,
    DENSITY_AXES,
    INFO_POOR_ID,
    INFO_POOR_KEY_ASSIGN,
    JOB_TYPES,
    MISSING,
    VERSION,
)
from segloom.functions.columns import cell_slug, info_density, is_missing
from segloom.operators.blocks import over_blocks
from segloom.operators.encoding import encode, fit_onehot, slot_values
from segloom.operators.ranking import split_train_test
from segloom.operators.stats import compress
from segloom.runtime import cut, scratch_path, sized

MIN_TRAIN_ROWS = 5
PARALLEL_FITS = 3  # Spark grows the trees of a forest on the driver, so only a few cells are there at once


def training_frame(assignments: DataFrame, attributes: DataFrame, features: Sequence[str] = AXES, key: str = "id") -> DataFrame:
    """Operational rows with their attributes, missing ones as the sentinel."""
    rows = assignments.filter(F.col("segment_id") != INFO_POOR_ID).select(key, *CELL, "segment_id", "segment_key")
    clean = [F.coalesce(F.col(a), F.lit(MISSING)).alias(a) for a in features]
    return rows.join(attributes.select(key, *clean), key)


def cell_gate(rows: DataFrame, label: str = "segment_id", min_rows: int = MIN_TRAIN_ROWS) -> DataFrame:
    """Per cell: training rows, classes, and whether it is trained or why not."""
    per = rows.groupBy(*CELL, label).agg(F.count("*").alias("n")).groupBy(*CELL).agg(
        F.sum("n").alias("n_train"), F.count("*").alias("n_classes")
    )
    reason = F.when(F.col("n_train") < min_rows, "too_few_samples").when(F.col("n_classes") < 2, "single_segment")
    return per.withColumn("decision", F.coalesce(reason, F.lit("train")))


def balanced_weights(table: DataFrame, label: str, by: Sequence[str] = (), weight: str = "n") -> DataFrame:
    """Adds `weight`: count times n / (classes * class rows).

    The factors, one row per class, are worked out first and broadcast: a join by label would
    bring the rows of a class, with all their columns, to one task.
    """
    by = list(by)
    classes = table.groupBy(*by, label).agg(F.sum(weight).alias("_c"))
    cell = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))  # one row per class
    factors = classes.select(*by, label, (F.sum("_c").over(cell) / (F.count("*").over(cell) * F.col("_c"))).alias("_f"))
    return table.join(sized(factors), [*by, label]).withColumn("weight", F.col(weight) * F.col("_f")).drop("_f")


class SavedForests(Mapping[str, RandomForestClassificationModel]):
    """Forests by cell that lie in the shared folder; one is loaded when it is asked for, so the driver keeps none."""

    def __init__(self, folders: Mapping[str, str]):
        self.folders = dict(folders)

    def __getitem__(self, cell: str) -> RandomForestClassificationModel:
        return RandomForestClassificationModel.load(self.folders[cell])

    def __iter__(self):
        return iter(self.folders)

    def __len__(self) -> int:
        return len(self.folders)

    def __contains__(self, cell: object) -> bool:
        return cell in self.folders

    @classmethod
    def of(cls, forests: Mapping[str, RandomForestClassificationModel], spark: SparkSession) -> SavedForests:
        if isinstance(forests, cls):
            return forests
        folders = {cell: scratch_path(spark, "forest") for cell in forests}
        for cell, model in forests.items():
            model.write().save(folders[cell])
        return cls(folders)


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Copies the files of a folder, replacing the target."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    here, there = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    there.getFileSystem(conf).delete(there, True)
    jvm.org.apache.hadoop.fs.FileUtil.copy(here.getFileSystem(conf), here, there.getFileSystem(conf), there, False, conf)


def tree_table(forests: Mapping[str, RandomForestClassificationModel], spark: SparkSession) -> DataFrame:
    """All trees of all cells as one written table: a row per (cell, tree).

    Arrays by node: `slot` that is tested (-1 at a leaf) and the nodes `low` and `high`
    without and with it; `leaf_node`, `leaf_class`, `leaf_share` are the shares of the
    classes that a leaf has. Read from the models' own files.
    """
    parts = None
    for cell, path in SavedForests.of(forests, spark).folders.items():
        here = spark.read.parquet(f"{path}/data").select(F.lit(cell).alias("_cell"), F.col("treeID").alias("tree"), "nodeData.*")
        parts = here if parts is None else parts.unionByName(here)
    if parts is None:
        return spark.createDataFrame([], TREES)
    leaf = F.col("leftChild") < 0
    stats = F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda acc, x: acc + x)
    found = F.filter(F.transform(stats, lambda x, i: F.struct(F.col("id").alias("node"), i.alias("cls"), (x / total).alias("share"))), lambda e: e["share"] > 0)
    left = F.col("split.leftCategoriesOrThreshold")

    def child(value: float) -> Column:
        """Where a slot with this value leads to; a split lists the values that go left, or their largest."""
        goes_left = F.when(F.col("split.numCategories") < 0, F.lit(value) <= left[0]).otherwise(F.array_contains(left, value))
        return F.when(leaf, -1).when(goes_left, F.col("leftChild")).otherwise(F.col("rightChild"))

    nodes = parts.select(
        "_cell", "tree", "id", F.when(leaf, -1).otherwise(F.col("split.featureIndex")).alias("slot"), child(0.0).alias("low"), child(1.0).alias("high"),
        F.when(leaf, found).alias("found"),
    )
    listed = nodes.groupBy("_cell", "tree").agg(F.array_sort(F.collect_list(F.struct("id", "slot", "low", "high", "found"))).alias("n"))
    leaves = F.flatten(F.array_compact(F.transform("n", lambda x: x["found"])))
    return cut(
        listed.withColumn("l", leaves).select(
            "_cell", "tree", F.col("n.slot").alias("slot"), "n.low", "n.high",
            F.col("l.node").alias("leaf_node"), F.col("l.cls").alias("leaf_class"), F.col("l.share").alias("leaf_share"),
        )
    )


TREES = "_cell string, tree int, slot array<int>, low array<int>, high array<int>, leaf_node array<int>, leaf_class array<int>, leaf_share array<double>"
TREE_BLOCK, TUPLE_BLOCK = 16, 20_000  # trees and tuples that a task takes at once


@dataclass
class CellModels:
    """Fitted cells: encoder, forest and class ids; other cells were skipped."""

    features: tuple[str, ...]
    encoders: dict[str, PipelineModel] = field(default_factory=dict)
    forests: Mapping[str, RandomForestClassificationModel] = field(default_factory=dict)
    classes: dict[str, list[int]] = field(default_factory=dict)
    trees: DataFrame | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        meta = []
        for cell, folder in SavedForests.of(self.forests, spark).folders.items():
            self.encoders[cell].write().overwrite().save(f"{path}/{cell}/encoder")
            copy_folder(spark, folder, f"{path}/{cell}/forest")
            meta.append((cell, json.dumps({"classes": self.classes[cell], "features": list(self.features)})))
        spark.createDataFrame(meta, "cell string, meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        self.all_trees(spark).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CellModels:
        out = cls(())
        for row in spark.read.parquet(f"{path}/meta").collect():
            meta = json.loads(row["meta"])
            out.features = tuple(meta["features"])
            out.classes[row["cell"]] = meta["classes"]
            out.encoders[row["cell"]] = PipelineModel.load(f"{path}/{row['cell']}/encoder")
        out.forests = SavedForests({cell: f"{path}/{cell}/forest" for cell in out.classes})
        out.trees = spark.read.schema(TREES).parquet(f"{path}/trees")
        return out

    def all_trees(self, spark: SparkSession) -> DataFrame:
        if self.trees is None:
            self.trees = tree_table(self.forests, spark)
        return self.trees

    def slots(self) -> dict[str, dict[str, dict[str, int]]]:
        """Per cell and feature, the slot of each value that the cell's encoder knows."""
        out: dict[str, dict[str, dict[str, int]]] = {}
        for cell, encoder in self.encoders.items():
            names, at = encoder.stages[0].getInputCols(), 0
            out[cell] = {}
            for name, values in zip(names, slot_values(encoder)):
                out[cell][name.removeprefix("_v_")] = {v: at + i for i, v in enumerate(values)}
                at += len(values)
        return out

    def predict(self, table: DataFrame, cells: Iterable[str] | None = None) -> DataFrame:
        """Predicted id and confidence of (cell, features) tuples; cells without a model are dropped.

        Blocks of a cell's trees meet blocks of its tuples, all cells in one plan; the
        shares of the trees are added up per tuple and class.
        """
        known = sorted(set(self.forests) & set(cells)) if cells is not None else sorted(self.forests)
        names, slots, n_classes = list(self.features), self.slots(), {c: len(ids) for c, ids in self.classes.items()}
        rows = table.withColumn("_cell", cell_slug()).filter(F.col("_cell").isin(*known) if known else F.lit(False))
        rows = cut(rows.withColumn("_key", F.monotonically_increasing_id()))
        trees = self.all_trees(table.sparkSession).withColumn("_key", F.col("tree").cast("long"))

        def votes(tuples: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            cell = tuples["_cell"].iloc[0]
            width = 1 + sum(len(v) for v in slots[cell].values())  # the last slot is never set
            has = np.zeros((len(tuples), width), bool)
            at = np.arange(len(tuples))
            for name, values in slots[cell].items():
                place = tuples[name].fillna(MISSING).map(values)
                some = place.notna().to_numpy()
                has[at[some], place[some].astype(int)] = True
            total = np.zeros((len(tuples), n_classes[cell]))
            for tree in trees.itertuples():
                slot, low, high = np.asarray(tree.slot), np.asarray(tree.low), np.asarray(tree.high)
                node = np.zeros(len(tuples), np.int64)
                while (slot[node] >= 0).any():
                    test = slot[node]
                    node = np.where(test < 0, node, np.where(has[at, test], high[node], low[node]))
                share = np.zeros((len(slot), n_classes[cell]))
                share[np.asarray(tree.leaf_node, int), np.asarray(tree.leaf_class, int)] = tree.leaf_share
                total += share[node]
            i, c = np.nonzero(total)
            return pd.DataFrame({"_key": tuples["_key"].to_numpy()[i], "_cell": cell, "cls": c.astype(np.int32), "share": total[i, c]})

        schema = "_key long, _cell string, cls int, share double"
        tuples = rows.select("_key", "_cell", *names)
        found = over_blocks(tuples, trees, ["_cell"], "_key", votes, schema, TUPLE_BLOCK, TREE_BLOCK)
        summed = found.groupBy("_key", "_cell", "cls").agg(F.sum("share").alias("share"))
        # Rounded, so that classes with equal votes tie whatever the order of the sums; the first class wins.
        best = summed.groupBy("_key", "_cell").agg(
            F.max(F.struct(F.round("share", 9).alias("s"), (-F.col("cls")).alias("c"))).alias("best"), F.sum("share").alias("all")
        )
        ids = [(cell, k, i) for cell, own in self.classes.items() for k, i in enumerate(own)]
        # A row per class of a model.
        of = F.broadcast(table.sparkSession.createDataFrame(ids, "_cell string, _class int, predicted_id int"))
        best = best.select("_key", "_cell", (-F.col("best.c")).alias("_class"), (F.col("best.s") / F.col("all")).alias("confidence"))
        return rows.join(best.join(of, ["_cell", "_class"]), ["_key", "_cell"]).select(*table.columns, "predicted_id", "confidence")


def forest(trees: int = 200, depth: int = 30, seed: int = 42, **options) -> RandomForestClassifier:
    """Random forest on weighted tuples.

    A bootstrap draws rows, not tuples: a tuple with many rows keeps its share in
    every draw. So the weights stand for the sample and no further one is drawn;
    the trees differ by their feature subsets. Spark's largest depth is 30. Node ids
    are cached, else every task of every level is sent all trees grown so far.
    """
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed,
        featureSubsetStrategy="sqrt", bootstrap=False, minInstancesPerNode=1, minInfoGain=0.0, cacheNodeIds=True, **options,
    )


def train_cells(
    rows: DataFrame, features: Sequence[str] = AXES, label: str = "segment_id", key: str = "id", trees: int = 200,
    depth: int = 30, test_share: float = 0.2, seed: int = 42, written: bool = False,
) -> tuple[CellModels, DataFrame, DataFrame]:
    """Models per cell, the gate table, and the held-out tuples with predictions.

    `rows` as from `training_frame`. The split is made on rows, per cell and class.
    `written` rows come from files without joins and are not written again.
    """
    rows = rows.select(key, *CELL, label, *features)
    if not written:  # read by the gate and by each pass of the split: what the rows are made of is worked out once
        rows = cut(rows)
    gate = cell_gate(rows, label)
    split = split_train_test(rows, label, CELL, key, test_share, seed)
    table = cut(compress(split, [*CELL, "is_test"], [*features, label]))
    decisions = gate.filter("decision = 'train'").select(cell_slug().alias("cell")).collect()  # <= 9 cells
    found = table.filter("NOT is_test").select(cell_slug().alias("cell"), label).distinct().collect()
    models = CellModels(tuple(features))
    spark, folders = rows.sparkSession, {}

    def fit(cell: str) -> tuple[str, PipelineModel, str, list[int]]:
        here = table.filter((cell_slug() == cell) & ~F.col("is_test"))
        classes = sorted(r[label] for r in found if r["cell"] == cell)
        position = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
        encoder = fit_onehot(here, features)
        data = encode(balanced_weights(here, label), encoder, features).withColumn("label", position.cast("double"))
        folder = scratch_path(spark, "forest")
        forest(trees, depth, seed).fit(data.select("features", "label", "weight")).write().save(folder)
        return cell, encoder, folder, classes

    with ThreadPool(PARALLEL_FITS) as pool:
        for cell, encoder, folder, classes in pool.imap(fit, sorted(r["cell"] for r in decisions)):
            models.encoders[cell], folders[cell], models.classes[cell] = encoder, folder, classes
    models.forests = SavedForests(folders)
    held_out = models.predict(table.filter("is_test"))
    return models, gate, held_out


def confusion(pred: DataFrame, by: Sequence[str] = (), y: str = "segment_id", predicted: str = "predicted_id", weight: str | None = None) -> DataFrame:
    """Confusion counts in long form."""
    size = F.sum(weight) if weight else F.count("*")
    return pred.groupBy(*by, F.col(y).alias("y"), F.col(predicted).alias("p")).agg(size.alias("n"))


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class (true or predicted) from `confusion`."""
    by = list(by)
    hit = F.col("y") == F.col("p")
    roles = F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("t"), F.lit(0).cast("long").alias("q"), F.when(hit, F.col("n")).otherwise(0).alias("h")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("t"), F.col("n").alias("q"), F.lit(0).cast("long").alias("h")),
    )
    per = counts.select(*by, F.inline(roles)).groupBy(*by, "label").agg(
        F.sum("t").alias("support"), F.sum("q").alias("predicted"), F.sum("h").alias("hits")
    )
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(F.lit(0.0))
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(F.col("support") + F.col("predicted") > 0, F.col("hits") * 2.0 / (F.col("support") + F.col("predicted"))).otherwise(F.lit(0.0))
    return per.withColumns({"precision": precision, "recall": recall, "f1": f1})


def score_summary(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and weighted F1 from `class_report`."""
    return report.groupBy(*by).agg(
        F.sum("support").alias("n"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )


def confidence_buckets(pred: DataFrame, by: Sequence[str] = (), confidence: str = "confidence", weight: str | None = None) -> DataFrame:
    """Shares of rows with confidence >= .9, >= .7 and < .5."""
    size = F.col(weight) if weight else F.lit(1)
    total = F.sum(size)

    def share(cond):
        return F.sum(F.when(cond, size).otherwise(0)) / total

    c = F.col(confidence)
    return pred.groupBy(*by).agg(
        total.alias("n"), share(c >= 0.9).alias("ge_09"), share(c >= 0.7).alias("ge_07"), share(c < 0.5).alias("lt_05")
    )


def assign(df: DataFrame, models: CellModels, catalog: DataFrame, ok: str | None = None, job_types: Iterable[str] = JOB_TYPES) -> DataFrame:
    """Adds status, segment_id, confidence, segment_key and version to every row.

    Precedence: unsupported type, failed extraction, info-poor, no model, predicted.
    """
    names = list(models.features)
    rows = df.withColumns({a: F.when(is_missing(a), MISSING).otherwise(F.col(a)) for a in names})
    good = F.coalesce(F.col(ok), F.lit(True)) if ok else F.lit(True)
    slug = cell_slug()
    status = (
        F.when(~F.coalesce(F.col("job_type").isin(*job_types), F.lit(False)), "invalid_recruit_type")
        .when(~good, "phase3_fail")
        .when(info_density(DENSITY_AXES) < 1, "info_poor")
        .when(~slug.isin(*models.forests) if models.forests else F.lit(True), "no_rf_model")
        .otherwise("ok")
    )
    rows = rows.withColumn("status", status)
    tuples = rows.filter("status = 'ok'").select(*CELL, *names).distinct()
    keys = catalog.select(*CELL, F.col("segment_id").alias("predicted_id"), F.col("segment_key").alias("_key"))
    known = models.predict(cut(tuples)).join(keys, [*CELL, "predicted_id"], "left")
    lookup = known.select(*CELL, *names, "predicted_id", F.col("confidence").alias("_p"), "_key")
    joined = rows.join(sized(lookup), [*CELL, *names], "left")
    state = F.col("status")
    poor = state.isin("info_poor", "no_rf_model")
    is_ok = state == "ok"
    return joined.withColumns(
        {
            "segment_id": F.when(is_ok, F.col("predicted_id")).when(poor, INFO_POOR_ID),
            "confidence": F.when(is_ok, F.col("_p")).when(state == "info_poor", 1.0).otherwise(F.lit(0.0)),
            "segment_key": F.when(is_ok, F.col("_key")).when(poor, INFO_POOR_KEY_ASSIGN),
            "segment_version": F.lit(VERSION),
        }
    ).drop("predicted_id", "_p", "_key")


def cluster_predict(pred: DataFrame, profiles: DataFrame, by: Sequence[str] = CELL) -> DataFrame:
    """Predictions with the size and dominant values of their cluster's profile.

    A predicted cluster without a profile is an error.
    """
    by = list(by)
    info = profiles.select(*by, F.col("cluster").alias("predicted_id"), F.col("size").alias("cluster_size"), "dominant_values")
    joined = pred.join(info, [*by, "predicted_id"], "left")
    fault = F.raise_error(F.format_string("no profile for cluster %d", "predicted_id"))
    return joined.withColumn("cluster_size", F.when(F.col("cluster_size").isNotNull(), F.col("cluster_size")).otherwise(fault.cast("long")))


def choose_model(baseline: DataFrame, challenger: DataFrame, by: str = "job_type", margin: float = 0.05) -> DataFrame:
    """Per type: the challenger if its macro F1 exceeds the baseline's by the margin, or there is none."""
    b = baseline.select(by, F.col("macro_f1").alias("baseline_f1"))
    c = challenger.select(by, F.col("macro_f1").alias("challenger_f1"))
    wins = F.col("baseline_f1").isNull() | (F.col("challenger_f1") >= F.col("baseline_f1") + margin)
    return c.join(b, by, "left").withColumns(
        {
            "adopted": F.when(wins, "challenger").otherwise("baseline"),
            "macro_f1_gain": F.round(F.col("challenger_f1") - F.col("baseline_f1"), 6),
        }
    )

