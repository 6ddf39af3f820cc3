"""Random-forest fitting and scoring with MLlib."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import SPLIT_SEED, ContractError, FlowContract
from ..functions.cells import ref
from ..session import remove, scratch

TREES, DEPTH, BINS = 20, 5, 32
#: Rows of a training task; the fitting keeps about 200 bytes of each between its passes.
TASK_ROWS = 250_000


def by_file(spark: SparkSession) -> SparkSession:
    """A session in which every file is read by a task of its own."""
    # Opening a file counts as much as a whole split, so no two files share one.
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    side = spark.newSession()
    side.conf.set("spark.sql.files.maxPartitionBytes", split)
    side.conf.set("spark.sql.files.openCostInBytes", split)
    return side


def in_tasks(train: DataFrame, path: str, rows: int = TASK_ROWS) -> DataFrame:
    """Rows stored in files of at most that many, each of which is read by a task of its own.

    Every pass of the fitting reads the kept rows of a partition in one task, and
    a split of a table that packs well holds millions of them.
    """
    train.write.option("maxRecordsPerFile", rows).parquet(path)
    return by_file(train.sparkSession).read.schema(train.schema).parquet(path)


def fit_forest(train: DataFrame, contract: FlowContract, weight: str | None = None, *, stored: bool = False):
    """Fit on ``train``; with ``weight`` every row counts as much as that column says.

    The rows are computed once and stored while the fitting reads them, unless
    they are ``stored`` already in files of at most TASK_ROWS, read ``by_file``.
    """
    forest = RandomForestClassifier(
        featuresCol=contract.vector,
        labelCol=contract.target,
        numTrees=TREES,
        maxDepth=DEPTH,
        maxBins=BINS,
        seed=SPLIT_SEED,
    )
    if weight:
        forest = forest.setWeightCol(weight)
    used = [contract.vector, contract.target, *([weight] if weight else [])]
    rows = train.select(*[ref(c) for c in used])
    if stored:
        return forest.fit(rows)
    path = scratch(train.sparkSession, "training-rows")
    try:
        return forest.fit(in_tasks(rows, path))
    finally:
        remove(train.sparkSession, path)


def importances(model: RandomForestClassificationModel, contract: FlowContract) -> list[tuple]:
    """(feature, importance), largest first, ties by name."""
    pairs = zip(contract.features, (float(v) for v in model.featureImportances.toArray()))
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def contract_report(model, contract: FlowContract) -> dict[str, tuple]:
    """What a loaded model must look like: check -> (found, required)."""
    return {
        "features": (model.numFeatures, len(contract.features)),
        "classes": (model.numClasses, 2),
        "features column": (model.getFeaturesCol(), contract.vector),
        "prediction column": (model.getPredictionCol(), "prediction"),
        "probability column": (model.getProbabilityCol(), "probability"),
    }


def load_forest(path: str, contract: FlowContract) -> RandomForestClassificationModel:
    """Load a saved forest and refuse one that does not fit the contract."""
    try:
        model = RandomForestClassificationModel.load(path)
    except Exception as cause:
        raise ContractError(f"no readable forest at {path}") from cause
    wrong = [
        f"{check}: {found} instead of {wanted}"
        for check, (found, wanted) in contract_report(model, contract).items()
        if found != wanted
    ]
    if wrong:
        raise ContractError(f"model at {path}: " + "; ".join(wrong))
    return model


def score(rows: DataFrame, model) -> DataFrame:
    """Prediction and probability of every row, probability as a plain array."""
    return model.transform(rows).withColumn("probability", vector_to_array(F.col("probability")))
