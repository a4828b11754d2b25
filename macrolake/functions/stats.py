"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_sum(value: str | Column, scale: int) -> Column:
    """Sum of a double column whose values have ``scale`` decimals.

    They are added as whole multiples of the last decimal, so the sum does not
    depend on the order in which tasks deliver their parts. Whole numbers are
    used rather than decimals because they stay in fixed-width registers; a sum
    beyond their range is an error, not a wrong result. Values of any number of
    decimals are added by :func:`sum_classes` and :func:`with_total`.
    """
    value = F.col(value) if isinstance(value, str) else value
    unit = F.lit(10.0**scale)
    return F.sum(F.rint(value * unit).cast("bigint")) / unit


def exact_avg(value: str | Column, scale: int) -> Column:
    """Mean of a double column; ``scale`` as in :func:`exact_sum`."""
    value = F.col(value) if isinstance(value, str) else value
    return F.try_divide(exact_sum(value, scale), F.count(value))


#: Bits of a limb of an exact sum, and the binary exponent at which limb 0 begins, below that of the least double.
LIMB, LOWEST = 28, -1148


def exponent_class(value: str) -> Column:
    """The limb at which a double's last bits begin; null for null, 0 for zero, -1 for NaN and infinities.

    The logarithm may be off by one at powers of two, so one bit more is taken.
    """
    return F.expr(
        f"CASE WHEN isnan({value}) OR abs({value}) = DOUBLE('Infinity') THEN -1 WHEN {value} = 0 THEN 0 "
        f"ELSE CAST((floor(log2(abs({value}))) - 53 - ({LOWEST})) div {LIMB} AS INT) END"
    )


def sum_classes(value: str, exponent: str) -> dict[str, Column]:
    """Aggregates over the rows of one :func:`exponent_class`: the sums of the values' three limbs, and of what is not finite.

    A finite double is a whole number of at most 81 bits times the power of
    two of its class. Scaling by powers of two and cutting at whole numbers is
    exact, and whole numbers are added, so the sums do not depend on any order.
    A limb takes 2^35 rows of one group; beyond that the sum is an error.
    """
    power = f"({LIMB} * ({exponent} + 2) + ({LOWEST}))"
    finite = f"CASE WHEN {exponent} >= 0 THEN {value} END"
    # Two steps, because one factor can be beyond the range of doubles.
    top = f"abs({finite}) * power(2D, -({power} div 2)) * power(2D, -({power} - {power} div 2))"
    high = f"floor({top})"
    middle = f"floor(({top} - {high}) * {1 << LIMB}D)"
    low = f"CAST((({top} - {high}) * {1 << LIMB}D - {middle}) * {1 << LIMB}D AS BIGINT)"
    limbs = {f"_limb{i}": F.expr(f"sum(CASE WHEN {value} < 0 THEN -({x}) ELSE {x} END)") for i, x in enumerate((low, middle, high))}
    return limbs | {"_special": F.expr(f"sum(CASE WHEN {exponent} = -1 THEN {value} END)")}


def with_total(rows: DataFrame, classes: str, special: str, name: str) -> DataFrame:
    """Add the correctly rounded total of ``classes``, an array of structs (class, limb0, limb1, limb2) with one entry for each class.

    There are at most 76 classes, so the array is bounded. The limbs are put in
    line, carries settled, and the number cut to 53 bits once, ties to even. A
    total without values is null; with NaN or infinities it is their sum.
    """
    mask, present = (1 << LIMB) - 1, f"filter({classes}, p -> p.class >= 0)"
    in_line = (
        f"transform(sequence(array_min(transform(_p, p -> p.class)), array_max(transform(_p, p -> p.class)) + 5), i -> aggregate(_p, 0L, (a, p) -> "
        "a + CASE i - p.class WHEN 0 THEN p.limb0 WHEN 1 THEN p.limb1 WHEN 2 THEN p.limb2 ELSE 0L END))"
    )

    def carried(limbs: str) -> str:
        start = "named_struct('carry', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>))"
        step = f"named_struct('carry', shiftright(s.carry + v, {LIMB}), 'digits', concat(s.digits, array((s.carry + v) & {mask}L)))"
        return f"aggregate({limbs}, {start}, (s, v) -> {step})"

    def digit(back: int) -> str:
        return f"coalesce(get(_digits, _top - {back}), 0L)"

    steps = {
        "_p": present,
        "_line": f"CASE WHEN size(_p) > 0 THEN {in_line} END",
        "_sum": carried("_line"),
        "_below": "_sum.carry < 0",
        "_digits": f"CASE WHEN _below THEN {carried('transform(_line, v -> -v)')}.digits ELSE _sum.digits END",
        "_top": "array_max(filter(sequence(0, size(_digits) - 1), i -> get(_digits, i) <> 0))",
        "_bits": f"length(bin({digit(0)}))",
        "_rest": f"shiftleft({digit(1)}, {LIMB}) | {digit(2)}",
        # 54 bits of the number, the last one to round by, and whether anything is left below them.
        "_cut": "shiftleft(" + digit(0) + ", 54 - _bits) | shiftright(_rest, _bits + 2)",
        "_more": "(_rest & (shiftleft(1L, _bits + 2) - 1)) <> 0 OR exists(slice(_digits, 1, greatest(_top - 2, 0)), d -> d <> 0)",
        "_mantissa": "shiftright(_cut, 1) + CASE WHEN (_cut & 1) = 1 AND (_more OR (shiftright(_cut, 1) & 1) = 1) THEN 1 ELSE 0 END",
        "_exponent": f"{LIMB} * (array_min(transform(_p, p -> p.class)) + _top) + ({LOWEST}) + _bits - 53",
        "_size": "_mantissa * power(2D, _exponent div 2) * power(2D, _exponent - _exponent div 2)",
    }
    helpers = [c for c in steps if c not in rows.columns]
    for helper, expression in steps.items():
        rows = rows.withColumn(helper, F.expr(expression))
    total = f"CASE WHEN {special} IS NOT NULL THEN {special} WHEN size(_p) = 0 THEN NULL WHEN _top IS NULL THEN 0D WHEN _below THEN -_size ELSE _size END"
    return rows.withColumn(name, F.expr(total)).drop(*helpers)


def paired_corr(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both columns are present.

    Null when there are no such rows or one column is constant; the built-in
    ``corr`` raises a division error there in ANSI mode.
    """
    x, y = f"if(`{b}` is null, null, `{a}`)", f"if(`{a}` is null, null, `{b}`)"
    return F.expr(f"try_divide(covar_pop({x}, {y}), stddev_pop({x}) * stddev_pop({y}))")


def paired_count(a: str, b: str) -> Column:
    """Number of rows where both columns are present."""
    return F.expr(f"count_if(`{a}` is not null and `{b}` is not null)")
