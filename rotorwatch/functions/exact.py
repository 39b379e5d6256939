"""Exact means of doubles in native aggregates: the same bits whatever the order of rows and partitions.

A finite double is an integer of 53 bits times a power of two, so it fits three limbs of 28 bits on one fixed grid of
binary places.  Rows are first summed by place (``limb_place``), in longs, which is exact in any order; a group has one or two places in
practice, 77 at most.  Those partial sums are then added as one long integer and rounded once, before the division by the count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorwatch.functions.columns import finite_or_null

BITS = 28  # of a limb; sums of limbs hold 2^35 rows of a group
_MASK = (1 << BITS) - 1


def _scaled(c: Column, power: Column) -> Column:
    """``c`` times 2 to the ``power``, in two steps, as the power itself may be no double."""
    half = F.floor(power / 2).cast("double")
    return c * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power.cast("double") - half)


def limb_place(c: Column) -> Column:
    """The grid place of a value's top limb.  An error of ``log2`` next to a power of two does no harm: three limbs have
    four bits to spare."""
    return F.when(c == 0, F.lit(0)).when(c.isNotNull(), F.floor(F.log2(F.abs(c)) / BITS).cast("int"))


def limb_sums(c: Column, place: Column) -> list[Column]:
    """Sums of a value's three limbs, the lowest first, for rows of one ``place``."""
    whole = _scaled(F.abs(c), (place - 2) * -BITS)
    sign = F.signum(c).cast("long")
    high = F.floor(whole / float(1 << 2 * BITS))
    rest = whole - high.cast("double") * float(1 << 2 * BITS)
    middle = F.floor(rest / float(1 << BITS))
    low = rest - middle.cast("double") * float(1 << BITS)
    return [F.sum(sign * x.cast("long")) for x in (low, middle, high)]


def partial_means(df: DataFrame, keys: Sequence[Column | str], columns: dict[str, str], *more: Column) -> DataFrame:
    """First step: ``df`` grouped by ``keys`` and by the places of ``columns`` (name in ``df`` -> name of its mean); each column's sums go to a
    struct named like its mean.  ``more``: other aggregates, to be combined by the caller."""
    for source, name in columns.items():  # NaN and infinity count as missing
        df = df.withColumn(f"_value_{name}", finite_or_null(source)).withColumn(f"_place_{name}", limb_place(F.col(f"_value_{name}")))
    sums = []
    for name in columns.values():
        low, middle, high = limb_sums(F.col(f"_value_{name}"), F.col(f"_place_{name}"))
        place = F.first(f"_place_{name}")
        sums.append(F.struct(place.alias("b"), low.alias("l0"), middle.alias("l1"), high.alias("l2"), F.count(f"_value_{name}").alias("n")).alias(name))
    grouped = df.groupBy(*keys, *(f"_place_{name}" for name in columns.values())).agg(*sums, *more)
    return grouped.drop(*(f"_place_{name}" for name in columns.values()))


def whole_mean(name: str) -> Column:
    """Second step: aggregate of the structs ``name`` of a group to the mean of its values, null when there are none."""
    return F.expr(_let(f"named_struct('parts', filter(collect_list({name}), p -> p.n > 0), 'n', sum({name}.n))", "g", _MEAN))


# The second step is written as SQL text: as Column calls, building it would take longer than running it.


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body``, in which ``name`` is ``value``, worked out once and written once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _two(power: str) -> str:
    return f"(CAST(floor(({power}) / 2) AS DOUBLE))"


def _times(value: str, power: str) -> str:
    """SQL of ``value`` times 2 to the ``power``, as in :func:`_scaled`."""
    return f"({value} * pow(2.0D, {_two(power)}) * pow(2.0D, CAST({power} AS DOUBLE) - {_two(power)}))"


def _int(value: str) -> str:
    return f"CAST({value} AS DECIMAL(20,0))"


def _whole(value: str) -> str:
    return f"CAST({value} AS DECIMAL(38,0))"


def _digit(back: int) -> str:
    return _int(f"CASE WHEN s.top >= {back} THEN get(s.d, s.top - {back}) ELSE 0L END")


# one place: the sum as two parts that are doubles as they are, so their sum is rounded once
_SIMPLE = _let(
    "named_struct('total', " + _whole(f"{_int('g.parts[0].l2')} * {1 << 2 * BITS} + {_int('g.parts[0].l1')} * {1 << BITS} + {_int('g.parts[0].l0')}") + ", 'b', g.parts[0].b)", "t",
    f"CASE WHEN abs(t.total) < {_whole(1 << 93)} THEN " + _times(
        f"((CAST(t.total div {1 << 40} AS DOUBLE) * {1 << 40}D + CAST(t.total - {_int(f't.total div {1 << 40}')} * {1 << 40} AS DOUBLE)) / g.n)", f"((t.b - 2) * {BITS})") + " END")

# more places: limbs at the same place add up, carries go upwards
_LIMBS = ("transform(sequence(array_min(g.parts.b) - 2, array_max(g.parts.b) + 3), k -> aggregate(g.parts, 0L, (a, p) -> a + "
          "CASE k WHEN p.b - 2 THEN p.l0 WHEN p.b - 1 THEN p.l1 WHEN p.b THEN p.l2 ELSE 0L END))")


def _carried(limbs: str) -> str:
    step = _let("a.c + y", "v", f"named_struct('c', shiftright(v, {BITS}), 'd', concat(a.d, array(v & {(1 << BITS) - 1}L)))")
    return f"aggregate({limbs}, named_struct('c', 0L, 'd', CAST(array() AS ARRAY<BIGINT>)), (a, y) -> {step})"


# the top 53 bits are rounded to even by all the rest
_NUMBER = _whole(f"{_whole(f'{_whole(f'{_int(f'{_digit(0)} * {1 << BITS} + {_digit(1)}')} * {1 << 2 * BITS}')} + {_digit(2)} * {1 << BITS} + {_digit(3)}')} * 2"
                 " + CAST(exists(slice(s.d, 1, greatest(s.top - 3, 0)), z -> z != 0) AS INT)")
_ROUNDED = _let(
    f"named_struct('number', {_NUMBER}, 'unit', shiftleft(1L, s.bits + 32))", "r", _let(
        f"r.number div {_int('r.unit')}", "q", _let(
            f"2 * CAST(r.number - {_int('q')} * {_int('r.unit')} AS BIGINT)", "twice", "CAST(q + CASE WHEN twice > r.unit OR (twice = r.unit AND q % 2 = 1) THEN 1L ELSE 0L END AS DOUBLE)")))
_LONG = _let(_LIMBS, "x", _let(_carried("x"), "up", _let(
    f"CASE WHEN up.c < 0 THEN {_carried('transform(x, w -> -w)')}.d ELSE up.d END", "digits", _let(
        "named_struct('d', digits, 'top', array_max(transform(digits, (w, i) -> CASE WHEN w != 0 THEN i END)))", "m", _let(
            "named_struct('d', m.d, 'top', m.top, 'bits', length(bin(get(m.d, m.top))))", "s",
            "CASE WHEN s.top IS NULL THEN 0D ELSE CASE WHEN up.c < 0 THEN -1D ELSE 1D END * "
            + _times(f"({_ROUNDED} / g.n)", f"((array_min(g.parts.b) + s.top - 5) * {BITS} + s.bits + 31)") + " END")))))

_MEAN = f"CASE WHEN g.n > 0 THEN coalesce(CASE WHEN size(g.parts) = 1 THEN {_SIMPLE} END, {_LONG}) END"
