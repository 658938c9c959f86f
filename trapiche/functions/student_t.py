"""Student t and F(1, dof) tails as Spark SQL expressions.

They act on model rows (one per model, or one per group), so the inference of
any number of groups stays inside the job that fitted them: no scalar has to
come back to the driver to look up a critical value.

Arguments are column names (or SQL expressions) of DOUBLE values.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Depth of the continued fraction: settled to 1e-12 for every number of degrees of
# freedom, given the two forms below.
FRACTION_DEPTH = 36

# The core form serves t^2 up to 3, and up to CORE_LIMIT beyond MANY_DOF degrees of
# freedom, where the far-tail form settles slowly and loses digits in 1 - t^2 / dof.
MANY_DOF = 30.0
CORE_LIMIT = 9.0

# Newton steps to a critical value: the starting value is the better the more degrees of
# freedom there are.
FEW_DOF_STEPS, MANY_DOF_STEPS = 4, 2

# Coefficients (power of 1/a, factor) of the large-a series of
# ln(gamma(a + 1/2) / gamma(a)) - ln(a) / 2. Fixed values.
HALF_STEP_SERIES = (
    (1, -1 / 8),
    (3, 1 / 192),
    (5, -1 / 640),
    (7, 17 / 14336),
    (9, -31 / 18432),
)
SERIES_SHIFT = 10


def _log_beta_half(a: str) -> str:
    """ln B(a, 1/2), without the cancellation of two log-gammas.

    The series holds for large a; the recurrence carries it down from a + SERIES_SHIFT.
    """
    far = f"({a} + {SERIES_SHIFT})"
    series = " + ".join(f"({c!r}D) / pow({far}, {p})" for p, c in HALF_STEP_SERIES)
    carried = (
        f"aggregate(sequence(0, {SERIES_SHIFT - 1}), 0D,"
        f" (total, k) -> total + ln(({a} + k) / ({a} + k + 0.5D)))"
    )
    return f"(0.5D * ln(pi()) - 0.5D * ln({far}) - ({series}) - {carried})"


def _beta_fraction(x: str, a: str, b: str) -> str:
    """Continued fraction of the incomplete beta function, evaluated from the bottom up."""
    m = "(level div 2)"
    even = f"{m} * ({b} - {m}) * {x} / (({a} + 2 * {m} - 1) * ({a} + 2 * {m}))"
    odd = f"-({a} + {m}) * ({a} + {b} + {m}) * {x} / (({a} + 2 * {m}) * ({a} + 2 * {m} + 1))"
    return (
        f"(1D / aggregate(sequence({FRACTION_DEPTH}, 1, -1), 1D,"
        f" (below, level) -> 1D + IF(level % 2 = 0, {even}, {odd}) / below))"
    )


def _two_sided(t: str, dof: str) -> str:
    square, half = f"({t} * {t})", f"({dof} / 2)"
    tail, core = f"({dof} / ({dof} + {square}))", f"({square} / ({dof} + {square}))"
    front = (
        f"exp(0.5D * ln({core}) - {half} * log1p({square} / {dof}) - {_log_beta_half(half)})"
    )
    in_core = f"{square} <= 3D OR ({dof} > {MANY_DOF!r}D AND {square} <= {CORE_LIMIT!r}D)"
    return f"""CASE
      WHEN {t} IS NULL OR {dof} IS NULL OR {dof} <= 0 THEN NULL
      WHEN {t} = 0 THEN 1D
      WHEN {square} = double('infinity') THEN 0D
      WHEN {in_core}
        THEN greatest(0D, 1D - 2D * {front} * {_beta_fraction(core, "0.5D", half)})
      ELSE {front} / {half} * {_beta_fraction(tail, half, "0.5D")} END"""


def t_two_sided_p(t: str, dof: str) -> Column:
    """P(|T| >= |t|) for `dof` degrees of freedom."""
    return F.expr(_two_sided(t, dof))


def f_tail(f: str, dof: str) -> Column:
    """P(F >= f) for (1, dof) degrees of freedom; F(1, dof) is the square of t(dof)."""
    return F.expr(_two_sided(f"sqrt({f})", dof))


def _density(t: str, dof: str) -> str:
    return (
        f"exp(-0.5D * ln({dof}) - {_log_beta_half(f'({dof} / 2)')}"
        f" - ({dof} + 1) / 2 * log1p({t} * {t} / {dof}))"
    )


def _start(alpha: float, dof: str) -> str:
    """Exact for 1 and 2 degrees of freedom; else the normal quantile corrected by powers of 1/dof."""
    z = NormalDist().inv_cdf(1 - alpha / 2)
    one = 1 / math.tan(math.pi * alpha / 2)
    two = (1 - alpha) * math.sqrt(2 / (alpha * (2 - alpha)))
    corrections = (
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
    )
    terms = [f"({c!r}D) / pow({dof}, {i})" for i, c in enumerate(corrections, 1)]
    series = " + ".join([f"{z!r}D", *terms])
    return f"CASE {dof} WHEN 1D THEN {one!r}D WHEN 2D THEN {two!r}D ELSE {series} END"


def t_critical(alpha: float, dof: str) -> Column:
    """t with P(|T| >= t) = alpha; null when `dof` is not positive."""
    if not 0.0 < alpha < 1.0:
        raise ValueError(f"alpha must lie in (0, 1), got {alpha}")
    start = _start(alpha, dof)
    # Newton in (ln t, ln p), where the curve is close to straight even for heavy tails.
    # The inner aggregate over one element only names the value of p.
    move = f"u * exp(ln(p / {alpha!r}D) * p / (2D * {_density('u', dof)} * u))"
    step = f"aggregate(array({_two_sided('t', dof)}), t, (u, p) -> {move})"
    return F.expr(
        f"CASE WHEN {dof} > 0 THEN"
        f" aggregate(sequence(1, IF({dof} > {MANY_DOF!r}D, {MANY_DOF_STEPS}, {FEW_DOF_STEPS})),"
        f" {start}, (t, step) -> {step}) END"
    )
