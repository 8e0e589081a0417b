"""Column expressions over class probabilities and gauge values. No Python UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smoothing inside the logarithm, decimals shown, class names.
ENTROPY_EPSILON = 1e-10
SCORE_DECIMALS = 4
ACCEPT = "Accept"
DECLINE = "Decline"

# Colour bands of the three dashboard gauges; each step holds from
# its lower edge (inclusive) up to the next.
BANDS = {
    "api_avg_confidence": [(None, "red"), (0.7, "yellow"), (0.9, "green")],
    "api_prediction_entropy": [(None, "green"), (0.5, "yellow"), (0.8, "red")],
    "api_distribution_shift": [(None, "green"), (2.0, "yellow"), (4.0, "red")],
}


def entropy(*probabilities: Column, epsilon: float = ENTROPY_EPSILON) -> Column:
    """Shannon entropy in bits, one column per class."""
    terms = [p * F.log2(p + F.lit(epsilon)) for p in probabilities]
    return -reduce(lambda a, b: a + b, terms)


def entropy_of(probabilities: Column, epsilon: float = ENTROPY_EPSILON) -> Column:
    """The same over an array of class probabilities."""
    return F.aggregate(
        probabilities, F.lit(0.0), lambda acc, p: acc - p * F.log2(p + F.lit(epsilon))
    )


def confidence(*probabilities: Column) -> Column:
    """Largest class probability."""
    return F.greatest(*probabilities)


def argmax_class(*probabilities: Column) -> Column:
    """Index of the largest probability; the first one on ties."""
    best = F.greatest(*probabilities)
    index = F.lit(len(probabilities) - 1)
    for i in range(len(probabilities) - 2, -1, -1):
        index = F.when(probabilities[i] == best, F.lit(i)).otherwise(index)
    return index


def decision_label(p_accept: Column, p_decline: Column) -> Column:
    """A tie accepts, as the first class wins ties."""
    return F.when(p_decline > p_accept, F.lit(DECLINE)).otherwise(F.lit(ACCEPT))


def round_score(value: Column) -> Column:
    return F.round(value, SCORE_DECIMALS)


def band_of(value: Column, steps: list[tuple[float | None, str]]) -> Column:
    """Name of the highest step whose lower edge is at or below the value."""
    out = F.lit(steps[0][1])
    for edge, name in steps[1:]:
        out = F.when(value >= F.lit(edge), F.lit(name)).otherwise(out)
    return F.when(value.isNotNull(), out)


def band_label(metric: Column, value: Column) -> Column:
    """Band of a reading by the metric it belongs to; NULL for a metric without bands."""
    out = F.lit(None).cast("string")
    for name, steps in BANDS.items():
        out = F.when(metric == F.lit(name), band_of(value, steps)).otherwise(out)
    return out


def not_nan(column: Column) -> Column:
    """NULL is the only missing marker past the edge of the system; NaN becomes NULL."""
    return F.when(~F.isnan(column), column)


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch, for exact arithmetic on durations."""
    return F.unix_micros(ts.cast("timestamp"))


def rounded(value: Column, decimals: int = 6) -> Column:
    """Rounded for reporting, with negative zero folded into zero."""
    return F.round(value, decimals) + F.lit(0.0)
