"""Score scaling, stability and evidence terms, and text assembly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the score scale.
SCORE_OFFSET = 404.65547022
SCORE_FACTOR = 72.1347520444
SCORE_TOP = 1200
P_FLOOR = 0.001
P_CEIL = 0.999


def to_score(p: Column | str) -> Column:
    """Probability of the bad class to an integer score that rises with it; null and NaN give null."""
    p = F.col(p) if isinstance(p, str) else p
    clipped = F.least(F.greatest(p, F.lit(P_FLOOR)), F.lit(P_CEIL))
    points = F.bround(SCORE_OFFSET - SCORE_FACTOR * F.ln(clipped / (1 - clipped)), 0)
    bounded = F.least(F.greatest(points, F.lit(0.0)), F.lit(float(SCORE_TOP)))
    return F.when(p.isNotNull() & ~F.isnan(p.cast("double")), (F.lit(SCORE_TOP) - bounded).cast("int"))


def psi_term(x: Column, y: Column) -> Column:
    """(x - y) ln(x / y); null when either share is missing or zero."""
    return F.when((x > 0) & (y > 0), (x - y) * F.ln(F.try_divide(x, y)))


def bin_woe(good_share: Column, bad_share: Column) -> Column:
    """Evidence of a bin: 0 without bads, null (minus infinity) without goods."""
    return F.when(bad_share == 0, F.lit(0.0)).otherwise(F.ln(F.try_divide(good_share, bad_share)))


CATEGORY_GOOD_FLOOR = 1e-10


def category_woe(good_share: Column, bad_share: Column) -> Column:
    """Evidence of a category: a zero good share is floored instead of dropped."""
    floored = F.when(good_share == 0, F.lit(CATEGORY_GOOD_FLOOR)).otherwise(good_share)
    return F.when(bad_share == 0, F.lit(0.0)).otherwise(F.ln(F.try_divide(floored, bad_share)))


def chi_square(n1: Column, bad1: Column, n2: Column, bad2: Column) -> Column:
    """Chi-square of two bins against their pooled rates; 0 when the pooled rate is 0 or 1."""
    rate = F.try_divide(bad1 + bad2, n1 + n2)
    spread = (bad1 - n1 * rate) * (bad1 - n1 * rate) / n1 + (bad2 - n2 * rate) * (bad2 - n2 * rate) / n2
    return F.when((rate == 0) | (rate == 1), F.lit(0.0)).otherwise(
        F.try_divide(spread, rate) + F.try_divide(spread, 1 - rate)
    )


def month_of(time: Column | str) -> Column:
    """yyyy-MM of a timestamp, or the first seven characters of ISO text."""
    return F.substring(F.col(time) if isinstance(time, str) else time, 1, 7)


def percent_text(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def joined_text(*cols: Column | str, sep: str = ",") -> Column:
    """Columns as text joined by ``sep``; null if any part is null, as text concatenation gives."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(sep), part]
    return F.concat(*pieces)


def tuning_objective(train_auc: float, test_auc: float) -> float:
    """Test AUC in percent, penalised by two to the power of its distance from train."""
    train, test = 100 * train_auc, 100 * test_auc
    return test - 2 ** abs(test - train)
