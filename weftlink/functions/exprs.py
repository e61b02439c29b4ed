"""Small expressions (operators F7, F12-F15, MX1, A22, A25)."""

from __future__ import annotations

from pyspark.sql import functions as F


def hash01(c) -> F.Column:
    """a number in [0, 1) from an integer, the same everywhere."""
    return F.pmod(c.cast("long") * F.lit(2654435761), F.lit(1 << 32)) / float(1 << 32)


def holdout(c, per_mille: int = 100) -> F.Column:
    """F13."""
    return F.pmod(c.cast("long") * F.lit(2654435761), F.lit(1000)) < per_mille


def gate(p, lo: float | None, hi: float | None) -> F.Column:
    """open interval; no bounds: all."""
    return F.lit(True) if lo is None else (p > lo) & (p < hi)


def finite(c, other: float = 0.0) -> F.Column:
    """null, NaN and infinities become ``other``."""
    c = c.cast("double")
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), float(other)).otherwise(c)


def tri(a, b) -> F.Column:
    """1 equal, -1 different, 0 if a side is empty."""
    return F.when((a == "") | (b == ""), 0).when(a == b, 1).otherwise(-1).cast("tinyint")


def logit(p) -> F.Column:
    """MX1."""
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(q / (1 - q))


def sigmoid(z) -> F.Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-40.0)), F.lit(40.0))))


def f_half(n_true, k, tp) -> F.Column:
    """F0.5 of one entity."""
    return F.when(k == 0, F.when(n_true == 0, 1.0).otherwise(0.0)).when(tp == 0, 0.0).otherwise(1.25 * tp / (0.25 * n_true + k))


def oracle_f_half(n_true, tp) -> F.Column:
    """The best F0.5 with the candidates there are."""
    return F.when(n_true == 0, 1.0).when(tp > 0, 1.25 * tp / (0.25 * n_true + tp)).otherwise(0.0)
