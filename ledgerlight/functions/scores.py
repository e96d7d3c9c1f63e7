"""Score formulas as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight import constants as K
from ledgerlight.functions.values import _col, clamp, first_match


def weighted_sum(terms: list[tuple[float, Column]]) -> Column:
    """Left-to-right sum of weight * term: zone bounds are compared unrounded, so the order matters."""
    return reduce(Column.__add__, [F.lit(weight) * term for weight, term in terms])


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator where the denominator is positive, else null."""
    return F.when(_col(denominator) > 0, _col(numerator) / _col(denominator))


def z_ratios() -> dict[str, Column]:
    return {
        "x1_wc_to_assets": ratio("working_capital", "assets_total"),
        "x2_re_to_assets": ratio("retained_earnings", "assets_total"),
        "x3_ebit_to_assets": ratio("ebit", "assets_total"),
        "x4_equity_to_liab": ratio("equity", "liabilities_total"),
        "x5_rev_to_assets": ratio("revenue", "assets_total"),
    }


def z_score() -> Column:
    """Winsorised Z' of an annual row; null when any ratio is missing (a null ratio makes the sum null)."""
    total = weighted_sum([(weight, F.col(name)) for name, weight in K.Z_WEIGHTS.items()])
    return F.when(F.col("fiscal_period") == "FY", clamp(total, -K.Z_LIMIT, K.Z_LIMIT))


def z_zone(z: Column | str) -> Column:
    z = _col(z)
    return first_match(
        F.lit("safe"),
        [
            (z.isNull(), F.lit(None).cast("string")),
            (z < K.Z_DISTRESS_BELOW, F.lit("distress")),
            (z <= K.Z_GREY_UP_TO, F.lit("grey")),
        ],
    )


def z_component(z: Column | str) -> Column:
    """Z' turned into 0 (safe) ... 1 (distress), neutral when unknown."""
    z = _col(z)
    return first_match(
        F.lit(1.0) - z / F.lit(K.Z_SAFE_AT),
        [
            (z.isNull(), F.lit(K.NEUTRAL)),
            (z <= 0, F.lit(1.0)),
            (z >= K.Z_SAFE_AT, F.lit(0.0)),
        ],
    )


def trend_component() -> Column:
    """Decline flags and sharp drops, weighted; a missing signal counts as none."""
    terms = []
    for name, weight in K.TREND_WEIGHTS.items():
        if name in K.TREND_DROP_BELOW:
            signal = F.coalesce(F.col(name) < K.TREND_DROP_BELOW[name], F.lit(False)).cast("double")
        else:
            signal = F.coalesce(clamp(F.col(name).cast("double"), 0.0, 1.0), F.lit(0.0))
        terms.append((weight, signal))
    return clamp(weighted_sum(terms), 0.0, 1.0)


def composite_score() -> Column:
    terms = [(weight, F.col(name)) for name, weight in K.COMPOSITE_WEIGHTS.items()]
    return clamp(weighted_sum(terms), 0.0, 1.0)


def composite_zone(score: Column | str) -> Column:
    score = _col(score)
    return first_match(
        F.lit("grey"),
        [
            (score.isNull(), F.lit(None).cast("string")),
            (score > K.COMPOSITE_DISTRESS_ABOVE, F.lit("distress")),
            (score < K.COMPOSITE_SAFE_BELOW, F.lit("safe")),
        ],
    )


def risk_label(mean_risk: Column | str) -> Column:
    mean_risk = _col(mean_risk)
    return first_match(
        F.lit(K.TOP_RISK_LABEL),
        [
            (mean_risk.isNull(), F.lit(None).cast("string")),
            *[(mean_risk < bound, F.lit(label)) for bound, label in K.RISK_LABEL_BELOW],
        ],
    )


def risk_points(level: Column | str) -> Column:
    """Risk level in hundredths. Whole numbers keep a company's mean independent of the order of summing."""
    level = F.lower(_col(level))
    rules = [(level == name, F.lit(points)) for name, points in K.RISK_POINTS.items()]
    return first_match(F.lit(K.UNKNOWN_RISK_POINTS), rules)


def growth(current: Column | str, previous: Column, signed: bool = False) -> Column:
    """Relative change. ``signed`` measures also work on a negative base, against its absolute value."""
    current = _col(current)
    if signed:
        return F.when(previous != 0, (current - previous) / F.abs(previous))
    return F.when(previous > 0, (current - previous) / previous)
