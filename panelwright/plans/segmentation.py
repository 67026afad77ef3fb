"""Segmentation run: grid, choice of K, final fits, profiles and sensitivity to an added measure."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from panelwright.operators import segment
from panelwright.sources.sinks import save_model, write_table
from panelwright.spec import SEGMENT_KS, SEGMENT_SEEDS, PanelSpec


@dataclass
class Segmentation:
    experiments: DataFrame
    chosen: DataFrame
    pipelines: dict[str, PipelineModel]
    assigned: DataFrame


def run(
    frame: DataFrame,
    variants: dict[str, tuple[str, ...]],
    ks: tuple[int, ...] = SEGMENT_KS,
    seeds: tuple[int, ...] = SEGMENT_SEEDS,
    tolerance: float = 0.01,
) -> Segmentation:
    """Fits the grid, picks K and seed per variant, and assigns every row under every variant.

    The picked fits are the grid's own models: refitting the same K and seed on the same
    rows would only repeat work.
    """
    grid = segment.kmeans_grid(frame, variants, ks, seeds)
    chosen = segment.choose_k(grid.experiments, ["variant"], tolerance)
    pipelines = {r["variant"]: grid.pipeline(r["variant"], r["k"], r["seed"]) for r in chosen.collect()}
    assigned = frame
    for variant, pipeline in pipelines.items():
        *stages, model = pipeline.stages
        for stage in [*stages, model.copy().setPredictionCol(f"cluster_{variant}")]:
            assigned = stage.transform(assigned)
        assigned = assigned.drop("features_raw", segment.FEATURES)
    return Segmentation(grid.experiments, chosen, pipelines, assigned)


def sensitivity(result: Segmentation, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """Cross-tabulation of two variants' clusters and the share of rows that agree after relabelling.

    Both assignments sit on the same rows, so nothing is joined; assignments stored apart
    are matched on the key by ``segment.cross_tab``.
    """
    a, b = f"cluster_{first}", f"cluster_{second}"
    crossed = result.assigned.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    return crossed, segment.agreement(crossed, a, b)


def save(result: Segmentation, variant: str, spec: PanelSpec, model_path: str, table_path: str) -> int:
    """Saves the pipeline of a variant and its assignments by key; returns the rows written."""
    save_model(result.pipelines[variant], model_path)
    return write_table(result.assigned.select(*spec.key, f"cluster_{variant}"), table_path)
