"""Column rules of the silver and gold layers, built from Spark's own expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_outside(c: Column | str, low, high) -> Column:
    """Keep values in ``[low, high]``; anything else, NULL included, becomes NULL."""
    return F.when(_col(c).between(low, high), _col(c))


def null_if_nonpositive(c: Column | str) -> Column:
    return F.when(_col(c) > 0, _col(c))


def one_of(c: Column | str, allowed: Iterable, default) -> Column:
    """``c`` where it is one of ``allowed``, otherwise (NULL included) ``default``."""
    return F.when(_col(c).isin(list(allowed)), _col(c)).otherwise(F.lit(default))


def fixed_length(c: Column | str, n: int) -> Column:
    return F.when(F.length(_col(c)) == n, _col(c))


def bucket(c: Column | str, floors: Sequence[tuple], default) -> Column:
    """Label of the first floor that ``c`` reaches; list the highest floor first.

    Values below every floor, and NULL, get ``default``.
    """
    (first_floor, first_label), *others = floors
    labelled = F.when(_col(c) >= first_floor, F.lit(first_label))
    for floor, label in others:
        labelled = labelled.when(_col(c) >= floor, F.lit(label))
    return labelled.otherwise(F.lit(default))


def money(c: Column | str, precision: int = 12) -> Column:
    """Two-digit decimal; a value that does not fit becomes NULL and never fails the job."""
    return _col(c).try_cast(f"decimal({precision},2)")


def proper_case(c: Column | str) -> Column:
    return F.initcap(F.trim(_col(c)))


def guarded_pct(part: Column, whole: Column, digits: int = 2, default=0.0) -> Column:
    """``part / whole`` in percent where ``whole`` is positive, else ``default``."""
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(default))
