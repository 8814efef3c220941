"""String hashes kept JVM-side as higher-order expressions.

Both hashes fold the UTF-16 code units of a string left to right, as the
JVM's ``charAt`` loop does: a character outside the Basic Multilingual Plane
contributes its high and then its low surrogate. They stay inside
whole-stage codegen: no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .time import col_of

_TWO32 = 1 << 32
_TWO31 = 1 << 31


def _code_units(s: Column) -> Column:
    # split(s, '') gives one element per character ('' for the empty string);
    # drop the empty element so the empty string folds to the seed 0.
    return F.filter(F.split(s, ""), lambda ch: F.length(ch) > 0)


def _fold_units(acc: Column, ch: Column, step) -> Column:
    """Apply ``step(acc, unit)`` for the one or two UTF-16 units of character ``ch``."""
    cp = F.ascii(ch).cast("long")
    hi = F.lit(0xD800) + F.shiftright(cp - F.lit(0x10000), 10)
    lo = F.lit(0xDC00) + (cp - F.lit(0x10000)).bitwiseAND(F.lit(0x3FF))
    return F.when(cp > F.lit(0xFFFF), step(step(acc, hi), lo)).otherwise(step(acc, cp))


def java_string_hash(c) -> Column:
    """Java ``String.hashCode``: h = 31*h + unit with signed 32-bit wrap."""
    chars = _code_units(col_of(c))
    unsigned = F.aggregate(
        chars, F.lit(0).cast("long"),
        lambda acc, ch: _fold_units(acc, ch, lambda a, u: (a * 31 + u) % _TWO32),
    )
    return F.when(unsigned >= _TWO31, unsigned - _TWO32).otherwise(unsigned).cast("int")


def hash_code(c, factor: int) -> Column:
    """Scalar UDF semantics of the table demo: hashCode(s) * factor as a 32-bit int."""
    h = java_string_hash(c).cast("long") * F.lit(int(factor))
    u = F.pmod(h, F.lit(_TWO32))
    return F.when(u >= _TWO31, u - _TWO32).otherwise(u).cast("int")


def poly_hash(c, seed: int = 61, bits: int = 29) -> Column:
    """Bitmap offset of the unique-visitor job: fold acc*seed + ch, keep low ``bits``.

    Masking every step keeps the low bits of the 32-bit wrap exactly.
    """
    mask = (1 << bits) - 1
    chars = _code_units(col_of(c))
    return F.aggregate(
        chars, F.lit(0).cast("long"),
        lambda acc, ch: _fold_units(acc, ch, lambda a, u: (a * seed + u).bitwiseAND(F.lit(mask))),
    )
