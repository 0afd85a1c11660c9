"""Sums of doubles that do not depend on the order of addition.

A finite double is split, without error, into four whole numbers below 2^25 on
a fixed grid: x = sum of part[i] * 2^(24 * (slot - i)), i = 0..3, where ``slot`` follows from
the size of x. Whole numbers add up exactly in any order, so partial sums by (key, slot)
merge map-side like any SUM; a key has as many slots as its values have sizes (one or two for
amounts of money, 88 at most). At the end the few slots of a key are brought
together with carries and rounded once, to the double nearest the exact sum.

The result is the same at any number of partitions and under any retry. As with SUM, NULLs are
left out and no value at all gives NULL; a NaN, or infinities of both signs, give
NaN, infinities of one sign give that infinity. A slot of one key holds 2^37 rows (10^11);
beyond that the whole-number sum overflows, which is raised, never wrapped.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a part, and the range of slots of finite doubles.
BITS, LOWEST, HIGHEST = 24, -64, 64
PARTS = 4
#: 2^(12 * k): half a slot's scale, so that no scale overflows. Generated from the rule.
_HALVES = "array(" + ", ".join(f"{2.0 ** (12 * k)!r}D" for k in range(LOWEST, HIGHEST + 1)) + ")"


def _half_scale(slot: str) -> str:
    return f"element_at({_HALVES}, cast({slot} as int) - ({LOWEST}) + 1)"


def _split(name: str, source: str) -> dict[str, str]:
    """Columns of the parts, each from those before it (all steps are exact)."""
    unit = f"{float(1 << BITS)!r}D"
    return {
        f"{name}_odd": f"CASE WHEN isnan({source}) OR abs({source}) = double('Infinity') THEN {source} END",
        f"{name}_x": f"CASE WHEN {name}_odd IS NULL THEN {source} END",
        f"{name}_slot": f"CASE WHEN {name}_x = 0 THEN 0 ELSE cast(floor(log2(abs({name}_x)) / {BITS}) as int) END",
        f"{name}_r0": f"{name}_x * {_half_scale(f'-{name}_slot')} * {_half_scale(f'-{name}_slot')}",
        **{k: v for i in range(PARTS) for k, v in {
            f"{name}_p{i}": f"cast({name}_r{i} as bigint)",
            f"{name}_r{i + 1}": f"({name}_r{i} - {name}_p{i}) * {unit}"}.items() if i < PARTS - 1 or k.endswith(f"p{i}")},
    }


def _carried(entries: str, sign: str) -> str:
    """Digits (0 to 2^24 - 1) of sign * the sum, lowest first, and the carry left."""
    own = f"aggregate({entries}, 0L, (a, e) -> CASE WHEN e.at = k THEN a + e.n ELSE a END)"
    return (f"aggregate(sequence(array_min(transform({entries}, e -> e.at)), array_max(transform({entries}, e -> e.at))),"
            f" struct(0L AS carry, cast(array() as array<bigint>) AS digits), (state, k) ->"
            f" transform(array(state.carry + {sign} * {own}), t -> struct(shiftright(t, {BITS}) AS carry,"
            f" concat(state.digits, array(t & {(1 << BITS) - 1}L)) AS digits))[0])")


def _rounded(name: str) -> dict[str, str]:
    """The double nearest the sum of the slots in ``name``_slots. The usual key has one slot: its sum is
    rounded in a few additions (``_plain`` columns). Others go the general way, digit by digit."""
    mask, base = f"{(1 << BITS) - 1}L", 1 << BITS
    part = [f"get({name}_slots, 0).parts[{i}]" for i in range(PARTS)]
    lead = f"{part[0]} + shiftright({part[1]} + shiftright({part[2]} + shiftright({part[3]}, {BITS}), {BITS}), {BITS})"
    # a sum of parts is cut in two, so that digits and carries stay below 2^50 however many there are
    high = [f"shiftright(s.parts[{i}], {BITS})" for i in range(PARTS)] + ["0L"]
    low = ["0L"] + [f"(s.parts[{i}] & {mask})" for i in range(PARTS)]
    entries = ", ".join(f"struct(s.slot + 1 - {i} AS at, {low[i]} + {high[i]} AS n)" for i in range(PARTS + 1))
    top = [f"coalesce(get({name}_digits, {name}_top - {i}), 0L)" for i in range(PARTS)]
    mantissa = f"cast({top[0]} as decimal(38,0))"
    for digit in top[1:]:
        mantissa = f"cast({mantissa} * {base} + {digit} as decimal(38,0))"
    rest = f"exists(slice({name}_digits, 1, greatest({name}_top - {PARTS - 1}, 0)), d -> d <> 0)"
    lowest, slot = f"({name}_low + {name}_top - {PARTS - 1})", f"get({name}_slots, 0).slot"
    return {
        f"{name}_lead": f"CASE WHEN size({name}_slots) = 1 THEN {lead} END",
        f"{name}_plain": f"coalesce(abs({name}_lead) < {1 << 53}L, false)",
        f"{name}_side": f"CASE WHEN {name}_lead < 0 THEN -1L ELSE 1L END",
        f"{name}_m3": f"CASE WHEN {name}_plain THEN {name}_side * {part[3]} END",
        f"{name}_m2": f"{name}_side * {part[2]} + shiftright({name}_m3, {BITS})",
        f"{name}_m1": f"{name}_side * {part[1]} + shiftright({name}_m2, {BITS})",
        f"{name}_m0": f"cast({name}_side * {part[0]} + shiftright({name}_m1, {BITS}) as double)",
        # the next 48 bits, exactly; of the last 24 it matters beside a large number only that there are some
        f"{name}_next": f"cast(({name}_m1 & {mask}) * {base}L + ({name}_m2 & {mask}) as double) * {2.0 ** -48!r}D",
        f"{name}_last": f"CASE WHEN {name}_m0 < {2.0 ** 30!r}D THEN cast({name}_m3 & {mask} as double) * {2.0 ** -72!r}D"
                        f" WHEN {name}_m3 & {mask} <> 0 THEN {2.0 ** -49!r}D ELSE 0.0D END",
        f"{name}_near": f"{name}_m0 + {name}_next",
        # near plus its error and the rest, both exact: one rounding
        f"{name}_short": f"{name}_side * ({name}_near + (({name}_next - ({name}_near - {name}_m0)) + {name}_last))"
                         f" * {_half_scale(slot)} * {_half_scale(slot)}",
        f"{name}_entries": f"CASE WHEN NOT {name}_plain THEN flatten(transform({name}_slots, s -> array({entries}))) END",
        f"{name}_first": _carried(f"{name}_entries", "1"),
        # the exact sum is negative if and only if the last carry is
        f"{name}_sum": f"CASE WHEN {name}_first.carry < 0 THEN {_carried(f'{name}_entries', '-1')} ELSE {name}_first END",
        f"{name}_low": f"array_min(transform({name}_entries, e -> e.at))",
        f"{name}_digits": f"concat({name}_sum.digits, array({name}_sum.carry & {mask}, shiftright({name}_sum.carry, {BITS})))",
        f"{name}_top": f"array_max(transform({name}_digits, (d, i) -> CASE WHEN d <> 0 THEN i ELSE -1 END))",
        # four digits and a last bit for all below them round as the whole number does
        f"{name}_value": f"CASE WHEN {name}_plain THEN {name}_short WHEN {name}_top < 0 THEN 0.0D"
                         f" ELSE CASE WHEN {name}_first.carry < 0 THEN -1 ELSE 1 END"
                         f" * cast(cast({mantissa} * 2 + CASE WHEN {rest} THEN 1 ELSE 0 END as decimal(38,0)) as double)"
                         f" * 0.5D * {_half_scale(lowest)} * {_half_scale(lowest)} END",
    }


def _with(df: DataFrame, steps: Iterable[Mapping[str, str]]) -> DataFrame:
    """Add the columns of several such lists step by step, one projection a step: a column that is used
    twice is computed once."""
    for level in zip(*(s.items() for s in steps)):
        df = df.withColumns({name: F.expr(expression) for name, expression in level})
    return df


def _names(sums: Iterable[str]) -> dict[str, str]:
    return {out: f"_{i}" for i, out in enumerate(sums)}


def _added(rows: DataFrame, keys: Sequence[str], own: Mapping[str, str], counts: Iterable[str]) -> DataFrame:
    """Parts and counts added up by key and slots."""
    parts = [f"{n}_p{i}" for n in own.values() for i in range(PARTS)]
    return rows.groupBy(*keys, *[f"{n}_slot" for n in own.values()]).agg(
        *[F.sum(p).alias(p) for p in parts], *[F.sum(f"{n}_odd").alias(f"{n}_odd") for n in own.values()],
        *[F.sum(c).alias(c) for c in counts])


def slot_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], counts: Mapping[str, Column]) -> DataFrame:
    """``df`` grouped by ``keys`` and the slots of the double columns ``sums`` (output: input), with
    the sums of their parts and of the whole-number columns ``counts``; to be finished by ``merged_sums``,
    joined with other tables meanwhile if need be."""
    own = _names(sums)
    rows = df.select(*keys, *[F.col(c).cast("double").alias(f"{own[out]}_in") for out, c in sums.items()],
                     *[c.cast("long").alias(out) for out, c in counts.items()])
    rows = _with(rows, [_split(n, f"{n}_in") for n in own.values()])
    return _added(rows, keys, own, counts)


def merged_sums(slotted: DataFrame, keys: Sequence[str], sums: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """``keys``, counts and sums of rows of ``slot_sums``, which may be repeated or have no parts (as after a
    left join). A key without a value has the sum NULL, a count of no rows is NULL too."""
    own = _names(sums)
    merged = _added(slotted, keys, own, counts).groupBy(*keys).agg(
        *[F.expr(f"collect_list(CASE WHEN {n}_p0 IS NOT NULL THEN struct({n}_slot AS slot,"
                 f" array({', '.join(f'{n}_p{i}' for i in range(PARTS))}) AS parts) END)").alias(f"{n}_slots")
          for n in own.values()],
        *[F.sum(f"{n}_odd").alias(f"{n}_odd") for n in own.values()], *[F.sum(c).alias(c) for c in counts])
    merged = _with(merged, [_rounded(n) for n in own.values()])
    return merged.select(*keys, *counts, *[
        F.expr(f"coalesce({n}_odd, CASE WHEN size({n}_slots) > 0 THEN {n}_value END)").alias(out)
        for out, n in own.items()])


def exact_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str],
               counts: Mapping[str, Column] = MappingProxyType({})) -> DataFrame:
    """``df`` grouped by ``keys``: the order-independent sum of the double column ``sums[out]`` as
    ``out``, and the sum of the whole-number column ``counts[out]`` as ``out``."""
    return merged_sums(slot_sums(df, keys, sums, counts), keys, list(sums), list(counts))
