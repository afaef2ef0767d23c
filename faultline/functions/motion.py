"""Ground-motion estimates and intensity classes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Attenuation:
    """log(value) = base + per_mag * M - decay * ln(km + 1) - per_depth * depth"""

    base: float
    per_mag: float
    decay: float
    per_depth: float


# Default coefficients and class bounds.
PGV = Attenuation(base=-2.5, per_mag=0.8, decay=1.2, per_depth=0.005)
PGD = Attenuation(base=-3.0, per_mag=0.9, decay=1.3, per_depth=0.006)
LOW, MODERATE = 0.1, 1.0


def motion(mag: Column, km: Column, depth: Column, p: Attenuation) -> Column:
    """Estimated ground motion; NULL where any input is NULL."""
    return F.exp(
        F.lit(p.base) + p.per_mag * mag - p.decay * F.log(km + 1) - p.per_depth * depth
    )


def pgv(mag: Column, km: Column, depth: Column, params: Attenuation = PGV) -> Column:
    return motion(mag, km, depth, params)


def pgd(mag: Column, km: Column, depth: Column, params: Attenuation = PGD) -> Column:
    return motion(mag, km, depth, params)


def intensity_label(
    value: Column, low: float = LOW, moderate: float = MODERATE, null_policy: str = "null"
) -> Column:
    """Low, Moderate or High.

    ``null_policy="null"`` leaves unknown motion unlabelled;
    ``"reference"`` lets it fall through to High, as a plain CASE does.
    """
    label = F.when(value < low, "Low").when(value < moderate, "Moderate")
    if null_policy == "reference":
        return label.otherwise("High")
    if null_policy != "null":
        raise ValueError(f"unknown null_policy {null_policy!r}")
    return label.when(value.isNotNull() & ~F.isnan(value), "High")


def high_flag(label: Column) -> Column:
    return F.coalesce(label == "High", F.lit(False))
