"""Causal track: clean panel -> stage 1 -> residuals -> stage 2 -> result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricepanel.lineage import cut
from pricepanel.operators import align as L, impute as I, regress as R


def filled_panel(focal: DataFrame, comp: DataFrame) -> DataFrame:
    """Competitor prices on exactly the focal's dates, completed by the fill cascade."""
    grid = L.reindex_to(comp.select("entity", "obs_date", "price"), focal)
    return I.fill_cascade(grid, comp)


def first_stage(focal: DataFrame, comp: DataFrame, focal_id: str = "FOCAL") -> dict[str, DataFrame]:
    """Completed panel, stage-1 models and residual panel (lazy)."""
    panel = filled_panel(focal, comp)
    first = R.stage1(panel)
    resid = R.residuals(panel, first).withColumn("focal_id", F.lit(focal_id))
    return {"panel": panel, "stage1": first, "residuals": resid}


def run(focal: DataFrame, comp: DataFrame, focal_id: str = "FOCAL") -> dict[str, DataFrame]:
    """All result tables of one focal.

    The residual panel and the model rows are stage boundaries: they are written
    to the shared folder once and every later table reads the written copy.
    """
    out = first_stage(focal, comp, focal_id)
    resid = cut(out["residuals"])
    design = R.stage2_design(focal.withColumn("focal_id", F.lit(focal_id)), resid)
    second = cut(R.stage2(design))
    terms = R.stage2_terms(second, design)
    return {
        **out,
        "residuals": resid,
        "design": design,
        "stage2": second,
        "terms": terms,
        "predictions": R.predictions(design, second),
    }
