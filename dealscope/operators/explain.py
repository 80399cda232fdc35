"""Per-deal feature contributions and their top-k long form.

* Linear models: contribution_j = w_j * (x_j - mean_j), pure column algebra.
* Tree ensembles: see ``treeshap`` (path-dependent Tree SHAP in
  ``mapInPandas``).
* ``top_contributions`` keeps the k largest absolute contributions per deal
  with an array sort inside each row (no shuffle) and explodes them with
  their rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import direction
from ..schemas import TOP_K_CONTRIBUTIONS
from .ranking import top_k_array, top_k_of_array


def linear_terms(weights: Mapping[str, float], means: Mapping[str, float],
                 columns: Mapping[str, str], digits: int | None = None
                 ) -> list[tuple[str, Column]]:
    """(feature name, contribution column) pairs: w * (x - mean)."""
    out = []
    for name, w in weights.items():
        c = F.lit(float(w)) * (F.col(columns[name]) - F.lit(float(means[name])))
        out.append((name, F.round(c, digits) if digits is not None else c))
    return out


def contributions_long(df: DataFrame, terms: Sequence[tuple[str, Column]],
                       id_col: str = "opportunity_id") -> DataFrame:
    """One row per (deal, feature) with its contribution (``shap_value``)."""
    items = F.array(*[F.struct(F.lit(n).alias("feature"), c.alias("shap_value"))
                      for n, c in terms])
    return df.select(id_col, F.inline(items))


def top_contributions(df: DataFrame, terms: Sequence[tuple[str, Column]],
                      k: int = TOP_K_CONTRIBUTIONS, id_col: str = "opportunity_id") -> DataFrame:
    """k strongest absolute contributions per deal: opportunity_id, feature,
    feature_value (always NULL), shap_value, direction, rank (1..k)."""
    return _explode_top(df.select(id_col, top_k_array(terms, k).alias("_top")), id_col)


def top_contributions_array(df: DataFrame, names: Sequence[str] | Column, array_col: str,
                            k: int = TOP_K_CONTRIBUTIONS, id_col: str = "opportunity_id"
                            ) -> DataFrame:
    """As ``top_contributions`` for an array<double> column of contributions."""
    top = df.select(id_col, top_k_of_array(names, F.col(array_col), k).alias("_top"))
    return _explode_top(top, id_col)


def _explode_top(top: DataFrame, id_col: str) -> DataFrame:
    top = top.select(id_col, F.posexplode("_top").alias("_pos", "_t"))
    return top.select(
        id_col,
        F.col("_t.name").alias("feature"),
        F.lit(None).cast("string").alias("feature_value"),
        F.col("_t.value").alias("shap_value"),
        direction(F.col("_t.value")).alias("direction"),
        (F.col("_pos") + 1).cast("int").alias("rank"))


def _vector_means(prepared: DataFrame, features_col: str = "features") -> list[float]:
    """Background means of the feature vector (one distributed aggregation)."""
    from pyspark.ml.stat import Summarizer
    row = prepared.select(Summarizer.mean(F.col(features_col)).alias("m")).first()
    return row["m"].toArray().tolist()


def explain(model, rows: DataFrame, background: DataFrame | None = None,
            k: int = TOP_K_CONTRIBUTIONS, id_col: str = "opportunity_id") -> DataFrame:
    """Top-k contributions per row for a fitted model (``FittedModel``).

    Trees: path-dependent Tree SHAP on the log-odds scale.  Logistic:
    coef_j * (x_j - mean_j) with means over ``background`` (the training rows).
    Empty input gives an empty frame with the same six columns.
    """
    from . import treeshap
    prepared = model.applied(rows)
    est = model.estimator_model
    if not hasattr(est, "coefficients"):
        return _explode_top(treeshap.tree_top(prepared, model, k, id_col=id_col), id_col)
    if background is None:
        raise ValueError("a linear model needs background rows for the feature means")
    means = _vector_means(model.applied(background))
    return linear_top(prepared, model.feature_names(), est.coefficients.toArray().tolist(), means, k, id_col)


def linear_top(prepared: DataFrame, names: Sequence[str], weights: Sequence[float], means: Sequence[float],
               k: int = TOP_K_CONTRIBUTIONS, id_col: str = "opportunity_id", features_col: str = "features") -> DataFrame:
    """Top-k of weight * (x - mean) over a feature vector.  Names, weights and means are arrays of a one-row
    table, so the plan has the same size whatever the number of levels."""
    from pyspark.ml.functions import vector_to_array
    model = prepared.sparkSession.createDataFrame(
        [(list(names), [float(w) for w in weights], [float(m) for m in means])], "names array<string>, weights array<double>, means array<double>")
    rows = prepared.select(id_col, vector_to_array(F.col(features_col)).alias("_x")).crossJoin(model)
    terms = F.zip_with(F.zip_with(F.col("_x"), F.col("means"), lambda x, m: x - m), F.col("weights"), lambda x, w: x * w)
    return _explode_top(rows.select(id_col, top_k_of_array(F.col("names"), terms, k).alias("_top")), id_col)
