"""Site classification: imputation, random forest, thresholds and final filters."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.quantiles import exact_quantiles_of


def median_impute(df: DataFrame, features: list[str], by: list[str]) -> DataFrame:
    """Missing features filled with the median of their group; feature_imputed tells which were.

    Medians are exact, of all features and groups in one selection; the table of medians has a row a group.
    """
    d = df.withColumn("feature_imputed", F.struct(*[F.col(f).isNull().alias(f) for f in features]))
    own = [F.col(k).alias(f"__m{i}") for i, k in enumerate(by)]
    med = exact_quantiles_of(df, by, features, [0.5]).groupBy(*own).agg(*[F.max(F.when(F.col("column") == f, F.col("value"))).alias(f"__med{i}") for i, f in enumerate(features)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__m{i}")) for i, k in enumerate(by)])
    d = d.join(med, same, "left").withColumns({f: F.coalesce(f, f"__med{i}") for i, f in enumerate(features)})
    return d.select(*df.columns, "feature_imputed")


def training_labels(df: DataFrame, truth: list[str], fails: str, test: Column | None = None) -> DataFrame:
    """label TP where a truth flag holds, FP where the hard filter fails; sites that are both, and held-out ones, are not trained on."""
    tp = None
    for t in truth:
        tp = F.col(t) if tp is None else tp | F.col(t)
    fp = F.col(fails)
    both = F.coalesce(tp, F.lit(False)) & F.coalesce(fp, F.lit(False))
    label = F.when(both, None).when(tp, "TP").when(fp, "FP")
    out = df.withColumns({"tp": tp, "fp": fp, "label": label})
    held = F.coalesce(test, F.lit(False)) if test is not None else F.lit(False)
    return out.withColumns({"test": held, "train": F.col("label").isNotNull() & ~held})


def balanced(df: DataFrame, key: str, fp_to_tp: float = 1.0, seed: int = 42) -> DataFrame:
    """Training rows with FP : TP brought to fp_to_tp by a hash sample of the larger side."""
    n = {r["label"]: r["n"] for r in df.filter("train").groupBy("label").agg(F.count("*").alias("n")).collect()}
    tp, fp = n.get("TP", 0), n.get("FP", 0)
    share = {"FP": min(1.0, fp_to_tp * tp / fp) if fp else 1.0, "TP": min(1.0, fp / (fp_to_tp * tp)) if tp and fp_to_tp else 1.0}
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return df.filter(F.col("train") & (u < F.when(F.col("label") == "FP", share["FP"]).otherwise(share["TP"])))


#: Rows times trees that a task of the forest works on. Bytes say little of its cost: 100,000 sites fit in one small file.
TREE_ROWS = 4_000_000


def dealt(df: DataFrame, tasks: int, key: str | None = None) -> DataFrame:
    """df in so many even tasks: by key and in its order, so that reruns agree whatever held the rows before, or in turn."""
    return df.repartition(tasks, key).sortWithinPartitions(key) if key else df.repartition(tasks)


def train_forest(train: DataFrame, numeric: list[str], categorical: list[str], label: str = "label", trees: int = 500, depth: int = 5, seed: int = 42, key: str | None = None) -> PipelineModel:
    """The fitted pipeline. Rows are dealt to tasks by their number; with a key, which is unique, the forest does not depend on where they lay."""
    indexed = [f"{c}_indexed" for c in categorical]
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_indexed", handleInvalid="keep") for c in categorical]
    stages += [StringIndexer(inputCol=label, outputCol="label_indexed", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=[*numeric, *indexed], outputCol="features", handleInvalid="keep")]
    prepared = Pipeline(stages=stages).fit(train)
    rows = prepared.transform(train).select("features", "label_indexed", *([key] if key else []))
    forest = RandomForestClassifier(labelCol="label_indexed", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    return PipelineModel([*prepared.stages, forest.fit(dealt(rows, max(1, -(-train.count() * trees // TREE_ROWS)), key))])


def apply_forest(model: PipelineModel, df: DataFrame) -> DataFrame:
    """df with prob_<class> columns and prediction, in a few tasks a core; labels are not needed."""
    label = next(s for s in model.stages if s.hasParam("outputCol") and s.getOrDefault("outputCol") == "label_indexed")
    out = dealt(df, 3 * df.sparkSession.sparkContext.defaultParallelism)
    for s in model.stages:
        if s is not label:
            out = s.transform(out)
    p = vector_to_array("probability")
    classes = label.labels
    out = out.withColumns({f"prob_{c}": F.get(p, F.lit(i)) for i, c in enumerate(classes)})
    out = out.withColumn("predicted", F.get(F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int")))
    return out.drop("features", "rawPrediction", "probability", "prediction", *[s.getOrDefault("outputCol") for s in model.stages if s.hasParam("outputCol")])


def feature_importance(model: PipelineModel) -> dict[str, float]:
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return {n.removesuffix("_indexed"): float(v) for n, v in zip(names, model.stages[-1].featureImportances.toArray())}


def test_accuracy(predicted: DataFrame, label: str = "label") -> float | None:
    n = predicted.filter(F.col(label).isNotNull()).groupBy(label, "predicted").agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in n)
    return sum(r["n"] for r in n if r[label] == r["predicted"]) / total if total else None


def assign_population(df: DataFrame, features: list[str], known: str, min_prob: float = 0.9, trees: int = 100, seed: int = 42, other: str = "oth") -> DataFrame:
    """Class of each row by a forest fitted on four fifths of the rows that have one; `other` below min_prob."""
    have = df.filter(F.col(known).isNotNull())
    train = have.filter(F.pmod(F.xxhash64(*features, F.lit(seed)), F.lit(5)) != 0)
    out = apply_forest(train_forest(train, features, [], known, trees, 10, seed), df)
    best = F.greatest(*[F.col(c) for c in out.columns if c.startswith("prob_")]) if sum(c.startswith("prob_") for c in out.columns) > 1 else F.lit(1.0)
    return out.withColumn("assigned", F.when(best >= min_prob, F.col("predicted")).otherwise(other))


def cutoff_from_bins(bins: DataFrame, bin_id: str, snv_bin: int, indel_bin: int) -> tuple[float | None, float | None]:
    """(snv, indel) probability cutoffs: the lowest score of the given bins."""
    at = lambda snv, b: F.min(F.when((F.col("snv") == snv) & (F.col("bin") == b), F.col("min_score")))
    r = bins.filter(F.col("bin_id") == bin_id).agg(at(True, snv_bin).alias("s"), at(False, indel_bin).alias("i")).first()
    return r["s"], r["i"]


def final_filters(df: DataFrame, snv_cut: float, indel_cut: float, inbreeding_cut: float = -0.3, imputed: dict[str, str] | None = None) -> DataFrame:
    """filters: the sorted names of RF, InbreedingCoeff, AC0 and MonoAllelic that apply; missing inbreeding does not fail.

    A missing probability is an error: every site must have been scored. Features that had been filled in (imputed:
    feature -> name of its flag within feature_imputed) are missing again; singleton tells sites with one raw copy,
    where the column ac_raw is there.
    """
    p = F.when(F.col("rf_probability").isNull(), F.raise_error(F.lit("a site has no probability")).cast("double")).otherwise(F.col("rf_probability"))
    rf = F.when(F.col("is_snv"), p < snv_cut).otherwise(p < indel_cut)
    tests = {"RF": rf, "InbreedingCoeff": F.coalesce(F.col("inbreeding") < inbreeding_cut, F.lit(False)), "AC0": F.col("ac_adj") == 0, "MonoAllelic": F.col("af_raw").isin(0.0, 1.0)}
    out = df.withColumn("filters", F.array_sort(F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))))
    if imputed:
        out = out.withColumns({f: F.when(~F.col(f"feature_imputed.{flag}"), F.col(f)) for f, flag in imputed.items()})
    return out.withColumn("singleton", F.col("ac_raw") == 1) if "ac_raw" in df.columns else out


def prediction_summary(df: DataFrame) -> DataFrame:
    """Counts by tp, fp, train, label and prediction of a scored table."""
    return df.groupBy("tp", "fp", "train", "label", "predicted").agg(F.count("*").alias("n"))


def pass_by_bin(df: DataFrame, snv_bin: int, indel_bin: int) -> DataFrame:
    """Adds PASS to the filter set where the bin of the site's type is low enough."""
    ok = F.when(F.col("is_snv"), F.col("bin") <= snv_bin).otherwise(F.col("bin") <= indel_bin)
    return df.withColumn("filters", F.when(ok, F.array_union("filters", F.array(F.lit("PASS")))).otherwise(F.col("filters")))


class RunRegistry:
    """Paths and metadata of classifier runs under one folder, by any file system that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, run: str, kind: str) -> str:
        if kind not in ("model", "training", "result"):
            raise ValueError(kind)
        return f"{self.folder}/{run}/{kind}"

    def runs(self) -> dict[str, dict]:
        """The newest entry of each run."""
        try:
            rows = self.spark.read.text(f"{self.folder}/runs").collect()
        except Exception as e:  # the registry begins empty
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return {}
        out: dict[str, dict] = {}
        for x in sorted((json.loads(r[0]) for r in rows), key=lambda x: x["version"]):
            out[x["run"]] = x
        return out

    def record(self, run: str, **what) -> None:
        version = 1 + max((x["version"] for x in self.runs().values()), default=0)
        self.spark.createDataFrame([(json.dumps({"run": run, "version": version, **what}),)], "value string").coalesce(1).write.mode("append").text(f"{self.folder}/runs")
