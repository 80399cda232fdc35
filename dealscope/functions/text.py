"""Text formatting as column expressions (no Python UDFs).

Python's ``format`` rounds the *exact binary value* of a double half-to-even,
while Java's formatter (behind ``format_string``) rounds half-up on the
shortest decimal form.  ``fixed`` reproduces Python exactly with integer
arithmetic: an error-free product gives the exact scaled value, and the
half-even decision compares exact doubles.  From 2**42 on the digits are put together
from exact pieces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.columns import num_or
from ..schemas import (DEFAULT_PRODUCT_TEXT, DEFAULT_REP_TEXT, LOWERS, MISSING_DISPLAY,
                       PROMPT_PREFIX, RAISES, SEVERITY_ABOVE, SEVERITY_NEAR,
                       SEVERITY_WELL_BEYOND)


_SPLIT = 134217729.0  # 2**27 + 1 (Veltkamp split constant)


def _split_const(b: float) -> tuple[float, float]:
    c = _SPLIT * b
    hi = c - (c - b)
    return hi, b - hi


def scaled_half_even(x: Column, d: int) -> Column:
    """round_half_even(|x| * 10**d) as bigint, decided on the exact binary value.

    ``p = a * 10**d`` is rounded; Dekker's error-free product gives its exact
    error ``err`` so that ``p + err`` is the exact scaled value.  The fraction
    ``p - floor(p) - 0.5`` is exact for p < 2**52, and comparing it with
    ``-err`` decides up / down / tie without any rounding.
    """
    if not 0 <= d <= 3:
        raise ValueError("d must be within 0..3")
    b = float(10 ** d)
    bh, bl = _split_const(b)
    a = F.abs(x.cast("double"))
    p = a * F.lit(b)
    c = a * F.lit(_SPLIT)
    ah = c - (c - a)
    al = a - ah
    err = ((ah * F.lit(bh) - p) + ah * F.lit(bl) + al * F.lit(bh)) + al * F.lit(bl)
    q0 = F.floor(p)
    diff = (p - q0) - F.lit(0.5)
    up = (diff > -err) | ((diff == -err) & (q0 % 2 == 1))
    return q0 + F.when(up, F.lit(1)).otherwise(F.lit(0))


_LARGE = float(2 ** 42)         # below, |x| * 10**3 is less than 2**52
_PIECE = float(2 ** 50)
_TOO_LARGE = 1e38               # beyond a decimal's 38 digits


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once and bound to a name."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _floor(c: Column) -> Column:
    """The whole part as a double (``floor`` would overflow a bigint)."""
    return c - F.pmod(c, F.lit(1.0))


def _large(a: Column, d: int) -> Column:
    """Python's digits of a double from 2**42 up: the whole part is put together as a decimal
    from 50-bit pieces, which are exact, and the fraction rounded by itself."""
    unit = F.lit(2 ** 50).cast("decimal(16,0)")

    def piece(c: Column) -> Column:
        return c.cast("bigint").cast("decimal(16,0)")

    def pieces(s: Column) -> Column:
        high = _floor(s["whole"] / F.lit(_PIECE))
        return F.struct(s["rest"].alias("rest"), high.alias("high"), (s["whole"] - high * F.lit(_PIECE)).alias("low"))

    def rounded(s: Column) -> Column:
        top = _floor(s["high"] / F.lit(_PIECE))
        digits = ((piece(top) * unit + piece(s["high"] - top * F.lit(_PIECE))).cast("decimal(31,0)") * unit
                  + piece(s["low"])).cast("decimal(38,0)")
        if d == 0:
            odd = F.pmod(s["low"], F.lit(2.0)) == 1
            q = F.when((s["rest"] > 0.5) | ((s["rest"] == 0.5) & odd), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        else:
            q = scaled_half_even(s["rest"], d)
        return F.struct(digits.alias("digits"), q.alias("q"))

    def written(s: Column) -> Column:
        carry = F.floor(s["q"] / F.lit(10 ** d)).cast("decimal(1,0)")
        whole = (s["digits"] + carry).cast("decimal(38,0)").cast("string")
        return whole if d == 0 else F.concat(whole, F.lit("."), F.lpad((s["q"] % F.lit(10 ** d)).cast("string"), d, "0"))

    split = _let(a, lambda v: F.struct(_floor(v).alias("whole"), (v - _floor(v)).alias("rest")))
    return _let(_let(_let(split, pieces), rounded), written)


def fixed(x: Column, d: int) -> Column:
    """Python's ``f"{x:.{d}f}"`` for a double column, d <= 3: NULL stays NULL, NaN and the
    infinities are written as Python does, -0.0 keeps its sign; NULL from 1e38 up."""
    x = x.cast("double")
    a = F.abs(x)
    finite = ~F.isnan(x) & (a < F.lit(float("inf")))
    small = F.when(finite & (a < F.lit(_LARGE)), x)
    q = scaled_half_even(small, d)
    if d == 0:
        body = q.cast("string")
    else:
        p = 10 ** d
        body = F.concat(F.floor(q / F.lit(p)).cast("bigint").cast("string"), F.lit("."),
                        F.lpad((q % F.lit(p)).cast("string"), d, "0"))
    large = F.when(finite & (a >= F.lit(_LARGE)) & (a < F.lit(_TOO_LARGE)), a)
    text = F.when(F.isnan(x), F.lit("nan")).when(~finite, F.lit("inf")).otherwise(F.coalesce(body, _large(large, d)))
    sign = F.when(~F.isnan(x) & x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, text)


def percent(x: Column, d: int) -> Column:
    """Python's ``f"{x:.{d}%}"``: the double is multiplied by 100 first."""
    return F.concat(fixed(x.cast("double") * F.lit(100.0), d), F.lit("%"))


def thousands(n: Column) -> Column:
    """Python's ``f"{n:,}"`` for integers."""
    return F.format_number(n.cast("bigint"), 0)


def severity(ratio: Column) -> Column:
    return (F.when(ratio >= 3, F.lit(SEVERITY_WELL_BEYOND))
            .when(ratio >= 2, F.lit(SEVERITY_ABOVE))
            .otherwise(F.lit(SEVERITY_NEAR)))


def deal_summary(rep: Column, product: Column, propensity: Column, days: Column,
                 norm: Column, ratio: Column) -> Column:
    """One-sentence rep-facing summary; missing numbers count as 0 and
    missing names take the default wording."""
    score = num_or(propensity)
    r = num_or(ratio)
    whole_days = num_or(days).cast("bigint")
    whole_norm = num_or(norm).cast("bigint")
    return F.concat(
        F.coalesce(rep.cast("string"), F.lit(DEFAULT_REP_TEXT)), F.lit("'s "),
        F.coalesce(product.cast("string"), F.lit(DEFAULT_PRODUCT_TEXT)),
        F.lit(" opportunity has a "), percent(score, 0),
        F.lit(" close propensity and has spent "), whole_days.cast("string"),
        F.lit(" days in Engaging, "), severity(r), F.lit(" the "), whole_norm.cast("string"),
        F.lit("-day historical norm; prioritize a next-step check before forecast review."))


def _text_or_none(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def deal_prompt(opportunity_id: Column, rep: Column, product: Column, account: Column,
                propensity: Column, days: Column, norm: Column, ratio: Column) -> Column:
    """Prompt text for an external summariser (batch hand-off, no call made).
    NULL when a number is missing: such rows use the deterministic summary."""
    complete = (propensity.isNotNull() & days.isNotNull() & norm.isNotNull()
                & ratio.isNotNull())
    text = F.concat(
        F.lit(PROMPT_PREFIX),
        F.lit("opportunity="), _text_or_none(opportunity_id),
        F.lit("; rep="), _text_or_none(rep),
        F.lit("; product="), _text_or_none(product),
        F.lit("; account="), _text_or_none(account),
        F.lit("; close_propensity="), fixed(propensity, 3),
        F.lit("; days_in_engaging="), days.cast("double").cast("bigint").cast("string"),
        F.lit("; historical_norm_days="), norm.cast("double").cast("bigint").cast("string"),
        F.lit("; stall_ratio="), fixed(ratio, 2), F.lit("."))
    return F.when(complete, text)


def direction(value: Column) -> Column:
    return F.when(value > 0, F.lit(RAISES)).otherwise(F.lit(LOWERS))


def display_or_dash(text: Column) -> Column:
    return F.coalesce(text, F.lit(MISSING_DISPLAY))
