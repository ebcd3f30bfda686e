"""Every registered query and its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxlake.plans import q_aggregates, q_filters, q_graph, q_joins, q_projections, q_sources, q_tables  # noqa: F401  they register
from voxlake.plans.register import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine density per dendrite."""
    return QUERIES["spine_density_per_dendrite"](spark, sf_dir)
