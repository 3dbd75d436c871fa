"""Predictive track for all focals at once: complete -> lag -> select -> validate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricepanel.lineage import cut
from pricepanel.operators import features as X, matrix as M, validate as V


def completed_rows(target: DataFrame, comp: DataFrame, method: str = "iterative") -> DataFrame:
    """Completed matrices of all focals, written once to the shared folder.

    Everything downstream (two designs, several passes each) reads the written
    copy, as separate stages of the analysis would.
    """
    return cut(M.complete_matrix(X.row_vectors(target, comp), method))


def oos_direct(rows: DataFrame, registry: DataFrame) -> dict[str, DataFrame]:
    design = X.oos_design(rows)
    models, scores = V.cv_direct(design.where("n_comp > 0"))
    return {
        "design": design,
        "models": models,
        "scores": scores,
        "cv": V.cv_summary(scores),
        "summary": V.run_summary(registry, design, models, scores),
    }


def oos_detrended(rows: DataFrame, registry: DataFrame) -> dict[str, DataFrame]:
    design = X.oos_design(rows)
    models, scores, failed = V.cv_detrended(design.where("n_comp > 0"))
    return {
        "design": design,
        "models": models,
        "scores": scores,
        "cv": V.cv_summary(scores),
        "summary": V.run_summary(registry, design, models, scores, failed),
    }


def insample(rows: DataFrame, include_contemporaneous: bool = True) -> DataFrame:
    design = X.insample_design(rows, include_contemporaneous=include_contemporaneous)
    columns = rows.groupBy("focal_id").agg(F.first("columns").alias("columns"))
    names = X.feature_dictionary(
        columns, "insample", include_contemporaneous=include_contemporaneous
    )
    return V.insample(design, names)
