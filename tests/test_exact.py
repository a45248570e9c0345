"""Fixed-point KPI values against Python's fractions."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from tallyspan.functions.numbers import fixed_ratio, rounded_share
from tallyspan.operators import kpi

D = dt.date


def half_up(x: Fraction, digits: int) -> Fraction:
    scaled = abs(x) * 10**digits
    whole = scaled.numerator // scaled.denominator
    whole += 2 * (scaled - whole) >= 1
    return Fraction(whole if x >= 0 else -whole, 10**digits)


def test_a_change_of_half_a_cent_is_rounded_away_from_zero(facts):
    rows = facts(
        {"spend": 10.03, "conversions": 2},
        {"date": D(2025, 5, 20), "spend": 10.02, "conversions": 2},
    )
    cac = kpi.kpi_30d_vs_prior(rows).first()
    assert (cac["last_30_value"], cac["prior_30_value"], cac["delta_abs"]) == (5.02, 5.01, 0.01)


def test_random_comparisons(spark):
    rng = random.Random(5)
    totals = []
    for _ in range(400):
        spends = [Decimal(rng.randrange(-(10 ** rng.randrange(1, 14)), 10 ** rng.randrange(1, 14))).scaleb(-rng.randrange(5)) for _ in "ab"]
        counts = [rng.choice([0, 1, 2, 3, 7, 8, 10**9 + 7, rng.randrange(1, 10**6), -4]) for _ in "ab"]
        totals.append((*spends, *counts))
    schema = "spend_now decimal(26,9), spend_before decimal(26,9), conversions_now long, conversions_before long"
    df = spark.createDataFrame(totals, schema)
    got = {}
    for spec in (kpi.COMPACT, kpi.THIRTY_DAY, kpi.METRICS):
        for r in kpi.kpi_long(df.selectExpr("*", "struct(*) AS key"), spec, ["key"]).collect():
            got[tuple(r["key"]), id(spec), r["metric"]] = [r[n] for n in spec.names]

    def value(name, spend, count, guard):
        if name in ("Spend", "Conversions"):
            return Fraction(spend if name == "Spend" else count)
        n, d = (Fraction(spend), Fraction(count)) if name == "CAC" else (Fraction(count) * 100, Fraction(spend))
        if d == 0 or (guard == "positive" and d < 0):
            return None
        return half_up(n / d, 12)

    for s1, s0, n1, n0 in totals:
        for spec in (kpi.COMPACT, kpi.THIRTY_DAY, kpi.METRICS):
            for name, digits in spec.digits:
                now, before = value(name, s1, n1, spec.guard), value(name, s0, n0, spec.guard)
                change = None if None in (now, before) else now - before
                share = None if change is None or not before else half_up(change / before * spec.pct_scale, spec.pct_digits)
                want = [None if x is None else half_up(x, digits) for x in (now, before, change)] + [share]
                key = (Decimal(s1).quantize(Decimal(10) ** -9), Decimal(s0).quantize(Decimal(10) ** -9), n1, n0)
                assert got[key, id(spec), name] == [None if w is None else float(w) for w in want], (key, name)


@pytest.mark.parametrize("guard", ["nonzero", "positive"])
def test_zero_divisors(spark, guard):
    one = spark.sql("SELECT CAST(3 AS DECIMAL(26, 9)) AS a, CAST(0 AS DECIMAL(19, 0)) AS b")
    assert one.selectExpr(fixed_ratio("a", "b", guard)).first()[0] is None
    assert one.selectExpr(rounded_share("a", "b", 100, 2)).first()[0] is None
    with pytest.raises(ValueError, match="guard"):
        fixed_ratio("a", "b", "never")


def test_quotients_keep_twelve_decimals(spark):
    for a, b in ((Decimal("99999999999999999"), 7), (Decimal("0.000000001"), 3), (Decimal("-2"), 3), (Decimal("100"), 10**9 + 7)):
        row = spark.sql(f"SELECT CAST('{a}' AS DECIMAL(26, 9)) AS a, CAST({b} AS DECIMAL(19, 0)) AS b")
        want = half_up(Fraction(a) / b, 12)
        assert Fraction(row.selectExpr(fixed_ratio("a", "b")).first()[0]) == want
    row = spark.sql("SELECT CAST(12345678901 AS DECIMAL(22, 0)) AS a, CAST('17.29' AS DECIMAL(26, 9)) AS b")
    got = row.selectExpr(fixed_ratio("a", "b")).first()[0]
    assert got == (Decimal(12345678901) / Decimal("17.29")).quantize(Decimal(10) ** -12, ROUND_HALF_UP)
