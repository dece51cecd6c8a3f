"""Exact global order statistics without sending a column through one task.

``median`` and ``percentile`` keep every distinct value of a column in one aggregation
buffer. Here a sketch of bounded size first brackets each wanted rank. Values outside the
bracket are clamped to its ends, which changes no order statistic inside it, so counting the
clamped values per distinct value gives the exact result while the shuffle only carries the
few values inside the bracket. If a bracket would still hold too many values it is narrowed by
another sketch over the rows strictly inside it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope.functions import clean_number

SKETCH_ACCURACY = 10_000
BRACKET_VALUES = 2_000_000


@dataclass
class _Rank:
    """Wanted order statistics ``low`` and ``high`` (0-based) and the bracket around them."""

    name: str
    slot: str
    low: int
    high: int
    weight: float
    start: float
    stop: float
    inside: float

    @property
    def value(self) -> Column:
        return F.col(self.slot)


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, tuple],
    accuracy: int = SKETCH_ACCURACY,
    bracket_values: int = BRACKET_VALUES,
    counts: dict[str, int] | None = None,
) -> dict[str, float | None]:
    """Linear-interpolated quantiles, ``{name: (column, q)}`` to ``{name: value}``.

    ``(column, q, position)`` asks for the 0-based order statistic ``position(n)`` instead,
    which has to lie within a few ranks of ``q * n``. Nulls and NaN are skipped; the value is
    None where no row is left. ``counts``, if given, receives the number of values of each name.
    Runs two jobs, plus two for each narrowing step.
    """
    if not wanted:
        return {}
    slots = {name: f"v{i}" for i, name in enumerate(wanted)}
    data = df.select(*[_number(wanted[n][0]).alias(slot) for n, slot in slots.items()])
    slack = 4.0 / accuracy
    sketch = data.agg(
        *[F.count(slot).alias(f"n_{slot}") for slot in slots.values()],
        *[
            F.percentile_approx(F.col(slot), _ends(wanted[n][1], wanted[n][1], slack), accuracy).alias(f"b_{slot}")
            for n, slot in slots.items()
        ],
    ).first()
    ranks = []
    for name, slot in slots.items():
        count = sketch[f"n_{slot}"]
        if counts is not None:
            counts[name] = count
        if count:
            bracket = sketch[f"b_{slot}"] if count > accuracy else (-math.inf, math.inf)
            ranks.append(_rank(name, slot, wanted[name], count, bracket, 3 * slack * count if count > accuracy else count))
    while any(r.inside > bracket_values for r in ranks):
        _narrow(data, [r for r in ranks if r.inside > bracket_values], slack, accuracy)
    found = _order_statistics(data, ranks)
    while missed := [r for r in ranks if r.name not in found]:
        # A sketch missed: begin again with wider brackets; in the end they hold every value.
        slack *= 4
        for r in missed:
            r.start, r.stop = -math.inf, math.inf
        _narrow(data, missed, slack, accuracy)
        while any(r.inside > bracket_values for r in missed):
            _narrow(data, [r for r in missed if r.inside > bracket_values], slack / 4, accuracy)
        found |= _order_statistics(data, missed)
    result: dict[str, float | None] = dict.fromkeys(wanted)
    for r in ranks:
        low, high = found[r.name]
        result[r.name] = low if r.weight == 0 else low + (high - low) * r.weight
    return result


def exact_median(df: DataFrame, *columns: str) -> dict[str, float | None]:
    return exact_quantiles(df, {c: (F.col(f"`{c}`"), 0.5) for c in columns})


def _number(c: Column | str) -> Column:
    return clean_number((F.col(c) if isinstance(c, str) else c).cast("double"))


def _ends(low: float, high: float, slack: float) -> list[float]:
    return [max(0.0, low - slack), min(1.0, high + slack)]


def _rank(name: str, slot: str, spec: tuple, count: int, bracket, inside: float) -> _Rank:
    if len(spec) == 3:
        position_of: Callable[[int], int] = spec[2]
        low = min(max(position_of(count), 0), count - 1)
        return _Rank(name, slot, low, low, 0.0, *bracket, inside)
    position = spec[1] * (count - 1)
    low = math.floor(position)
    return _Rank(name, slot, low, min(low + 1, count - 1), position - low, *bracket, inside)


def _narrow(data: DataFrame, ranks: list[_Rank], slack: float, accuracy: int) -> None:
    """Tighten each bracket by a sketch of the rows strictly inside it."""
    strict = {r.name: (r.value > r.start) & (r.value < r.stop) for r in ranks}
    upto = data.agg(
        *[F.count_if(r.value <= r.start).alias(f"upto_{r.slot}") for r in ranks],
        *[F.count_if(strict[r.name]).alias(f"inside_{r.slot}") for r in ranks],
    ).first()
    sketched = []
    for r in ranks:
        first, inside = upto[f"upto_{r.slot}"], upto[f"inside_{r.slot}"]
        if r.high < first:
            r.stop, r.inside = r.start, 0
        elif r.low >= first + inside:
            r.start, r.inside = r.stop, 0
        else:
            ends = _ends((r.low - first) / inside, (r.high - first) / inside, slack)
            expr = F.percentile_approx(F.when(strict[r.name], r.value), [max(0.0, e) for e in ends], accuracy)
            sketched.append((r, expr, r.low < first, r.high >= first + inside, inside))
    if not sketched:
        return
    row = data.agg(*[expr.alias(r.slot) for r, expr, *_ in sketched]).first()
    for r, _, keep_start, keep_stop, inside in sketched:
        low, high = row[r.slot]
        r.start = r.start if keep_start else low
        r.stop = r.stop if keep_stop else high
        r.inside = min(3 * slack * inside, inside) if inside > accuracy else 0


def _order_statistics(data: DataFrame, ranks: list[_Rank]) -> dict[str, tuple[float, float]]:
    """The wanted order statistics; a name is left out if one of its ranks lies outside the bracket."""
    if not ranks:
        return {}
    entries = [F.struct(F.lit(r.name).alias("name"), r.value.alias("value")) for r in ranks]
    start, stop = (_by_name({r.name: end(r) for r in ranks}) for end in (lambda r: r.start, lambda r: r.stop))
    below, beyond = F.col("value") < start, F.col("value") > stop
    clamped = F.when(below, start).when(beyond, stop).otherwise(F.col("value"))
    counts = (
        data.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .select("name", clamped.alias("value"), below.cast("long").alias("below"), beyond.cast("long").alias("beyond"))
        .groupBy("name", "value").agg(F.count(F.lit(1)).alias("count"), F.sum("below").alias("below"), F.sum("beyond").alias("beyond"))
    )
    upto = Window.partitionBy("name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("last", F.sum("count").over(upto) - 1)
    low, high = _by_name({r.name: r.low for r in ranks}), _by_name({r.name: r.high for r in ranks})
    first = F.col("last") - F.col("count") + 1
    hits = placed.filter(low.between(first, F.col("last")) | high.between(first, F.col("last")))
    by_name: dict[str, list[float]] = {}
    clamped_away = set()
    wanted = {r.name: r for r in ranks}
    for row in hits.select("name", "value", first.alias("first"), "last", "below", "beyond").collect():
        by_name.setdefault(row["name"], []).append(row["value"])
        for place in (wanted[row["name"]].low, wanted[row["name"]].high):
            if row["first"] <= place <= row["last"] and not row["first"] + row["below"] <= place <= row["last"] - row["beyond"]:
                clamped_away.add(row["name"])
    return {name: (min(values), max(values)) for name, values in by_name.items() if name not in clamped_away}


def _by_name(table: dict) -> Column:
    """Constant of the row's ``name``."""
    return F.try_element_at(F.create_map(*[F.lit(x) for item in table.items() for x in item]), F.col("name"))
