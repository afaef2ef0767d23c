"""Ground motion and intensity class per event, and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import motion as m


def ground_motion(
    nearest: DataFrame, pgv: m.Attenuation = m.PGV, pgd: m.Attenuation = m.PGD
) -> DataFrame:
    """Adds estimated_pgv and estimated_pgd from magnitude, distance_km, depth."""
    inputs = F.col("magnitude"), F.col("distance_km"), F.col("depth")
    return nearest.withColumns(
        {"estimated_pgv": m.pgv(*inputs, pgv), "estimated_pgd": m.pgd(*inputs, pgd)}
    )


def classify(
    moved: DataFrame, low: float = m.LOW, moderate: float = m.MODERATE, null_policy: str = "null"
) -> DataFrame:
    """Adds intensity_label and high_intensity_flag."""
    label = m.intensity_label(F.col("estimated_pgv"), low, moderate, null_policy)
    return moved.withColumn("intensity_label", label).withColumn(
        "high_intensity_flag", m.high_flag(F.col("intensity_label"))
    )


def high_intensity(classified: DataFrame) -> DataFrame:
    return classified.filter("high_intensity_flag")


def intensity_summary(classified: DataFrame) -> DataFrame:
    """Events per class and how many of them are high intensity."""
    return classified.groupBy("intensity_label").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("high_intensity_flag").alias("high_intensity_events"),
    )
