"""Feature preprocessing fitted on training rows, expressed as Spark ML stages.

Fit (a few aggregation jobs over the training rows; results are constants):
* most-frequent level per categorical (ties -> smallest): one distributed count over
  all columns, whatever their width;
* exact median per numeric (ML ``Imputer`` is approximate): distributed running counts
  over all columns, whatever their width;
* mean and *population* std of the imputed numerics (ML ``StandardScaler``
  uses the sample std); a zero std scales by 1.

Apply: a ``SQLTransformer`` carrying those constants (impute + scale), then
``StringIndexer`` (levels sorted, unknown kept in the last slot) and
``OneHotEncoder(dropLast=True)`` -- dropping exactly the unknown slot, so an
unseen level encodes as all zeros -- and a ``VectorAssembler``.  The result
is a plain ``PipelineModel`` that saves and loads with Spark's own writer.

``hash_bits`` replaces the indexed levels by a ``FeatureHasher`` of that many bits: nothing about the
levels is fitted, so no list of them reaches the driver or the model.  Meant for columns with
millions of levels and linear models; different levels may share a position.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexer,
                                VectorAssembler)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from .ranking import exact_quantiles

FEATURES_COL = "features"


def _sql_str(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_num(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({float(v)!r} AS DOUBLE)"


def fit_modes(train: DataFrame, cols: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """One row: most frequent non-null value per column (ties -> smallest).

    All columns are counted by one distributed group-by over (column, value); a second one
    keeps the best value of each column, so no task holds all levels of a column.
    """
    cols = list(cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_f"), F.col(c).cast("string").alias("_v"))
                                for i, c in enumerate(cols)]))
    counts = (train.select(pairs.alias("p")).select("p.*").where(F.col("_v").isNotNull())
              .groupBy("_f", "_v").agg(F.count(F.lit(1)).alias("_c")))
    best = counts.groupBy("_f").agg(F.min(F.struct((-F.col("_c")).alias("_c"), "_v")).alias("best"))
    return best.agg(*[F.max(F.when(F.col("_f") == i, F.col("best._v"))).alias(c) for i, c in enumerate(cols)])


def modes(train: DataFrame, cols: Sequence[str] = CATEGORICAL_FEATURES) -> dict:
    cols = list(cols)
    return fit_modes(train, cols).first().asDict() if cols else {}


def fit_medians(train: DataFrame, cols: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """One row of exact medians (see ``ranking.exact_quantiles``)."""
    return exact_quantiles(train, cols, 0.5)


def medians(train: DataFrame, cols: Sequence[str] = NUMERIC_FEATURES) -> dict:
    cols = list(cols)
    return fit_medians(train, cols).first().asDict() if cols else {}


def impute_exprs(modes: dict, medians: dict) -> list:
    return ([F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in modes.items()]
            + [F.coalesce(F.col(c).cast("double"), F.lit(v)).alias(c)
               for c, v in medians.items()])


def fit_scaling(imputed: DataFrame, cols: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return imputed.agg(*aggs)


def scaled(col: str, mean, std):
    scale = 1.0 if (std is None or std == 0.0) else std
    return (F.col(col) - F.lit(mean)) / F.lit(scale)


class FittedFeatures:
    """Fitted constants plus the ML stages that apply them.  ``model`` has the first stages, ``vector`` makes those of
    the feature vector when they are first asked for: Spark describes each of its positions in the column's metadata,
    some 500 bytes a level on the driver, which trees have no use for."""

    def __init__(self, modes: dict, medians: dict, means: dict, stds: dict,
                 categorical: Sequence[str], numeric: Sequence[str], model: PipelineModel, vector: Callable[[], list] | None = None):
        self.modes, self.medians, self.means, self.stds = modes, medians, means, stds
        self.categorical, self.numeric = list(categorical), list(numeric)
        self._first, self._vector = model, vector

    @cached_property
    def model(self) -> PipelineModel:
        return self._first if self._vector is None else PipelineModel(stages=self._first.stages + self._vector())

    @property
    def stages(self):
        return list(self.model.stages)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    def scaled(self, df: DataFrame) -> DataFrame:
        """``df`` with ``imp__`` and ``num__`` columns: imputed levels and scaled numbers."""
        return self._first.stages[0].transform(df)

    def indexed(self, df: DataFrame) -> DataFrame:
        """``df`` with ``imp__``, ``num__`` and ``idx__`` columns, without the feature vector."""
        return self._first.transform(df)

    @cached_property
    def _levels(self) -> list[list[str]]:
        return [list(v) for v in self._first.stages[1].labelsArray]

    def levels(self, k: int) -> list[str]:
        """Levels of the k-th categorical column, in the order of their indices."""
        return self._levels[k]

    def feature_names(self) -> list[str]:
        names = []
        for k, col in enumerate(self.categorical):
            names += [f"cat__{col}_{lvl}" for lvl in self.levels(k)]
        names += [f"num__{c}" for c in self.numeric]
        return names


class HashedFeatures(FittedFeatures):
    """Fitted constants and a hasher of the categorical levels."""

    def __init__(self, bits: int, *args):
        super().__init__(*args)
        self.bits = bits

    def levels(self, k: int) -> list[str]:
        raise ValueError("hashed features have no list of levels")

    def feature_names(self) -> list[str]:
        return [f"hash_{i}" for i in range(1 << self.bits)] + [f"num__{c}" for c in self.numeric]


def preprocess_sql(modes: dict, medians: dict, means: dict, stds: dict) -> str:
    parts = ["*"]
    for c, v in modes.items():
        parts.append(f"COALESCE(CAST(`{c}` AS STRING), {_sql_str(v)}) AS `imp__{c}`")
    for c, v in medians.items():
        std = stds[c]
        scale = 1.0 if (std is None or std == 0.0) else std
        parts.append(f"(COALESCE(CAST(`{c}` AS DOUBLE), {_sql_num(v)}) - {_sql_num(means[c])})"
                     f" / {_sql_num(scale)} AS `num__{c}`")
    return "SELECT " + ", ".join(parts) + " FROM __THIS__"


def fit_features(train: DataFrame, categorical: Sequence[str] = CATEGORICAL_FEATURES,
                 numeric: Sequence[str] = NUMERIC_FEATURES, hash_bits: int | None = None) -> FittedFeatures:
    mode_values = modes(train, categorical)
    meds = medians(train, numeric)
    imputed = train.select(*impute_exprs({}, meds))
    sc = fit_scaling(imputed, numeric).first()
    means = {c: sc[f"{c}__mean"] for c in numeric}
    stds = {c: sc[f"{c}__std"] for c in numeric}

    sql = SQLTransformer(statement=preprocess_sql(mode_values, meds, means, stds))
    if hash_bits is not None:
        hasher = FeatureHasher(inputCols=[f"imp__{c}" for c in categorical], outputCol="hashed", numFeatures=1 << hash_bits)
        assembler = VectorAssembler(inputCols=["hashed", *[f"num__{c}" for c in numeric]], outputCol=FEATURES_COL, handleInvalid="keep")
        return HashedFeatures(hash_bits, mode_values, meds, means, stds, categorical, numeric, PipelineModel(stages=[sql, hasher, assembler]))
    prepared = sql.transform(train)
    indexer = StringIndexer(inputCols=[f"imp__{c}" for c in categorical],
                            outputCols=[f"idx__{c}" for c in categorical],
                            stringOrderType="alphabetAsc", handleInvalid="keep").fit(prepared)

    def vector() -> list:
        encoder = OneHotEncoder(inputCols=[f"idx__{c}" for c in categorical],
                                outputCols=[f"ohe__{c}" for c in categorical],
                                dropLast=True).fit(indexer.transform(prepared))
        assembler = VectorAssembler(inputCols=[f"ohe__{c}" for c in categorical]
                                    + [f"num__{c}" for c in numeric],
                                    outputCol=FEATURES_COL, handleInvalid="keep")
        return [encoder, assembler]

    return FittedFeatures(mode_values, meds, means, stds, categorical, numeric, PipelineModel(stages=[sql, indexer]), vector)
