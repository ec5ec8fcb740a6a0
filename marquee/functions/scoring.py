"""Row-local scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import csv_list
from marquee.functions.weights import BLEND_WEIGHTS, UNLISTED_ITEM_LEVEL, UNLISTED_USER_LEVEL, maturity_level


def freshness(release_year: Column) -> Column:
    """0 for 2020 and earlier, rising to 1 in 2026."""
    return F.least(F.greatest((release_year - 2020) / 6.0, F.lit(0.0)), F.lit(1.0))


def genre_bonus(affinity_sum: Column) -> Column:
    return F.least(affinity_sum.cast("double") / 10.0, F.lit(1.0))


def available_in(region: Column, available_regions: Column, strict: bool = False) -> Column:
    """Region guardrail. The default is a substring test on the list; ``strict`` compares elements."""
    if strict:
        listed = csv_list(available_regions)
        return F.array_contains(listed, region) | F.array_contains(listed, F.lit("GLOBAL"))
    return F.contains(available_regions, region) | F.contains(available_regions, F.lit("GLOBAL"))


def suitable_for(item_rating: Column, user_rating: Column) -> Column:
    return maturity_level(item_rating, UNLISTED_ITEM_LEVEL) <= maturity_level(user_rating, UNLISTED_USER_LEVEL)


def blended_score(weights: dict[str, float] | None = None) -> Column:
    """Weighted sum of the component columns."""
    terms = [F.lit(weight) * F.col(name) for name, weight in (weights or BLEND_WEIGHTS).items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def reason() -> Column:
    """Name of the largest unweighted component; the first in blend order wins a tie."""
    names = list(BLEND_WEIGHTS)
    largest = F.greatest(*names)
    expr = F.lit(names[-1])
    for name in reversed(names[:-1]):
        expr = F.when(F.col(name) == largest, F.lit(name)).otherwise(expr)
    return expr


def deterministic_score(*parts: Column) -> Column:
    """A stable number in [0, 1] from the first 32 bits of the MD5 of the joined parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def weighted_choice_key(uniform: Column, weight: Column) -> Column:
    """Sort key whose largest value is a draw with probability proportional to the weight."""
    return F.round(F.ln(F.greatest(uniform, F.lit(1e-12))) / weight, 9)


def model_version_id(as_of: Column) -> Column:
    return F.concat(F.lit("hybrid-"), F.date_format(as_of, "yyyyMMddHHmmss"))
