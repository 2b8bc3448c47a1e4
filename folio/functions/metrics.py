"""Rating metrics shared by the gold views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: default shrinkage m of the Bayesian weighted rating.
DEFAULT_M = 25


def weighted_rating(votes, mean, prior, m: int = DEFAULT_M, digits: int = 3) -> Column:
    """Bayesian (IMDb) weighted rating ``(v/(v+m))*R + (m/(v+m))*C``, rounded.

    ``prior`` is the population mean C of the calling view; each view computes its own.
    A group without explicit grades has ``mean`` NULL and so a NULL result.
    """
    v = F.col(votes) if isinstance(votes, str) else votes
    r = F.col(mean) if isinstance(mean, str) else mean
    c = F.col(prior) if isinstance(prior, str) else prior
    mm = F.lit(m)
    return F.round((v / (v + mm)) * r + (mm / (v + mm)) * c, digits)


def ratio(numerator, denominator) -> Column:
    """Double division; NULL when the denominator is zero."""
    n = F.col(numerator) if isinstance(numerator, str) else numerator
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.when(d != 0, n / d)
