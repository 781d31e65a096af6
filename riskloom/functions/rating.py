"""Risk and price formulas, shared by feature building, request scoring and data generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom.functions.numeric import as_col, at_least, at_most, clamp, lookup, rounded


def age_points(age: Column | str, young, senior, other) -> Column:
    age = as_col(age)
    return F.when(age < fv.YOUNG_AGE, F.lit(young)).when(age > fv.SENIOR_AGE, F.lit(senior)).otherwise(F.lit(other))


def risk_score(age, years_licensed, claims_history, credit_score) -> Column:
    return rounded(
        age_points(age, 30, 20, 0)
        + as_col(claims_history) * 15
        + at_least(0, 40 - as_col(years_licensed))
        + at_least(0.0, (700 - as_col(credit_score)) / 10),
        2,
    )


def claims_per_year(claims_history, years_licensed) -> Column:
    return rounded(as_col(claims_history) / at_least(1, years_licensed), 4)


def credit_tier(credit_score: Column | str) -> Column:
    credit_score = as_col(credit_score)
    tier = None
    for bound, name in fv.CREDIT_TIERS:
        test = credit_score >= bound
        tier = F.when(test, name) if tier is None else tier.when(test, name)
    return tier.otherwise(fv.LOWEST_CREDIT_TIER)


def car_age(car_year: Column | str, year: int) -> Column:
    return F.lit(year) - as_col(car_year)


def car_value(car_make, age_years, kilometers, strict: bool = False) -> Column:
    """Base price x yearly depreciation x mileage factor (not rounded)."""
    base = lookup(fv.BASE_PRICES, car_make, None if strict else fv.DEFAULT_BASE_PRICE, strict)
    mileage = at_least(fv.KM_FACTOR_FLOOR, 1 - as_col(kilometers) / fv.KM_LIFETIME)
    return base * F.pow(F.lit(fv.DEPRECIATION_PER_YEAR), as_col(age_years).cast("double")) * mileage


def annual_premium(
    age, years_licensed, claims_history, credit_score, car_make, value, coverage_type, deductible,
    noise: Column | None = None,
) -> Column:
    """Base premium x eight factors (+ noise), bounded to the premium range (not rounded).

    An unknown make counts as 1.0; an unknown coverage or deductible is an error.
    """
    premium = (
        fv.BASE_PREMIUM
        * age_points(age, 1.5, 1.2, 1.0)
        * at_least(0.8, 1.3 - as_col(years_licensed) * 0.02)
        * (1 + as_col(claims_history) * 0.15)
        * at_least(0.8, 1.3 - (as_col(credit_score) - 600) / 500)
        * (1 + 0.03 * (as_col(value) / 10000))
        * lookup(fv.MAKE_FACTORS, car_make, 1.0)
        * lookup(fv.COVERAGE_FACTORS, coverage_type, strict=True)
        * lookup(fv.DEDUCTIBLE_FACTORS, deductible, strict=True)
    )
    if noise is not None:
        premium = premium + noise
    return clamp(premium, float(fv.PREMIUM_FLOOR), float(fv.PREMIUM_CEILING))


def monthly_instalment(annual: Column | str) -> Column:
    return as_col(annual) / 12


def eligible_years(age: Column | str) -> Column:
    """Most years a driver of this age can have been licensed; unknown for an unknown age."""
    return at_most(60, as_col(age) - 16)


def eligible(age: Column | str, years_licensed: Column | str) -> Column:
    years = as_col(years_licensed)
    return (years >= 1) & (years <= eligible_years(age))


def history_defaults(age, years_licensed, car_age_col, kilometers, value, credit_score=fv.NEW_CREDIT_SCORE) -> dict[str, Column]:
    """Feature columns for a key without history, taken from the request itself."""
    credit = F.lit(credit_score) if not isinstance(credit_score, Column) else credit_score
    claims = F.lit(fv.NEW_CLAIMS_HISTORY)
    return {
        "claims_history": claims,
        "credit_score": credit,
        "risk_score": risk_score(age, years_licensed, claims, credit),
        "avg_claims_per_year": F.lit(fv.NEW_AVG_CLAIMS_PER_YEAR),
        "credit_tier": credit_tier(credit),
        "total_policies": F.lit(fv.NEW_TOTAL_POLICIES),
        "avg_car_age": as_col(car_age_col),
        "avg_kilometers": as_col(kilometers),
        "total_car_value": as_col(value),
        "avg_deductible": F.lit(fv.NEW_AVG_DEDUCTIBLE),
    }
