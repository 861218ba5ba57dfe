"""Ordered computations spread over many tasks.

A window without PARTITION BY moves a whole table into one task. Here the rows are cut into
slices along the sort key first: each slice holds a bounded share of the rows, running values are
computed per slice, and what earlier slices add is joined on as one row per slice. Everything is
expressed with ordinary windows, so Spark shuffles, sorts and spills as usual.

The cut points come from a small sample and are fixed before the plan is built. They only decide
how work is spread; results do not depend on them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
ROWS_PER_SLICE = 200_000
SAMPLES_PER_SLICE = 20


def _as_double(df: DataFrame, column: str) -> Column:
    """Sort position as a double; NULL sorts first, as in Spark's ascending order. Times are seconds since 1970, dates days."""
    value, kind = F.col(column), df.select(column).schema[0].dataType
    if isinstance(kind, T.TimestampNTZType):
        # Without a zone, as a session's zone may skip or repeat an hour; a difference in seconds is a decimal with its microseconds.
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        value = (value - epoch).cast("interval second").cast("decimal(20,6)")
    elif isinstance(kind, T.DateType):
        value = F.unix_date(value)
    return F.coalesce(value.cast("double"), F.lit(float("-inf")))


@dataclass(frozen=True)
class _Cuts:
    """Cut points on the first sort key, and on the second one inside frequent first-key values."""

    first: tuple[float, ...]
    frequent: tuple[float, ...]
    second: tuple[float, ...]


def _cut_points(weighted: list[tuple[float, int]], parts: int) -> tuple[list[float], list[float]]:
    """Evenly spaced cut points over weighted sample values, and the values heavier than a part."""
    total = sum(weight for _, weight in weighted)
    step = total / parts
    cuts: set[float] = set()
    frequent: list[float] = []
    seen = 0
    for value, weight in sorted(weighted):
        if math.isnan(value) or math.isinf(value):
            seen += weight
            continue
        if weight > step:
            # A value of its own: nothing else may share its slice.
            frequent.append(value)
            cuts.update((value, math.nextafter(value, math.inf)))
        elif math.floor((seen + weight) / step) > math.floor(seen / step):
            cuts.add(value)
        seen += weight
    return sorted(cuts), frequent


def _bucket(df: DataFrame, column: str, cuts: Sequence[float], out: str) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    tmp = f"{out}_key"
    keyed = df.withColumn(tmp, _as_double(df, column))
    return (
        Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
        .transform(keyed)
        .drop(tmp)
    )


def slice_rows(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    *,
    source: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    n_rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """Add `_slice`, a number that never falls along `order` within one `by` series.

    `order` names columns of numbers, times or dates; the first must be exact as a double. A series that holds less
    than one slice's share of the rows stays whole in slice 0, a larger one is cut. `source` is a
    cheaper DataFrame with the same key columns to sample from. Returns the rows and whether
    there is more than one slice.
    """
    keys = [*by, *order[:2]]
    base = (df if source is None else source).select(*keys)
    if n_rows is None:
        n_rows = base.count()
    parts = math.ceil(n_rows / rows_per_slice)
    if parts <= 1:
        return df.withColumn(SLICE, F.lit(0).cast("long")), False

    sample = (
        base.sample(min(1.0, SAMPLES_PER_SLICE * parts / n_rows), seed=11)
        .select(*by, *[_as_double(base, c).alias(f"_k{i}") for i, c in enumerate(order[:2])])
        .groupBy(*by, *[f"_k{i}" for i in range(len(order[:2]))])
        .count()
        .collect()  # about SAMPLES_PER_SLICE rows per slice
    )
    total = sum(r["count"] for r in sample)
    if total == 0:
        return df.withColumn(SLICE, F.lit(0).cast("long")), False

    first: Counter = Counter()
    for r in sample:
        first[r["_k0"]] += r["count"]
    cuts, frequent = _cut_points(list(first.items()), parts)
    second: list[float] = []
    if frequent and len(order) > 1:
        inner: Counter = Counter()
        for r in sample:
            if r["_k0"] in set(frequent):
                inner[r["_k1"]] += r["count"]
        second, _ = _cut_points(list(inner.items()), parts)
    found = _Cuts(tuple(cuts), tuple(frequent), tuple(second))

    out = _bucket(df, order[0], found.first, "_b0")
    number = F.col("_b0").cast("long")
    if found.second:
        out = _bucket(out, order[1], found.second, "_b1")
        inside = F.when(_as_double(df, order[0]).isin(*found.frequent), F.col("_b1").cast("long")).otherwise(0)
        number = number * (len(found.second) + 2) + inside
    if by:
        share: Counter = Counter()
        for r in sample:
            share[tuple(r[c] for c in by)] += r["count"]
        large = [key for key, count in share.items() if count > total / parts]
        if not large:
            return df.withColumn(SLICE, F.lit(0).cast("long")), False
        number = F.when(_in_series(by, large), number).otherwise(0)
    return out.withColumn(SLICE, F.coalesce(number.cast("long"), F.lit(0))).drop("_b0", "_b1"), True


def _in_series(by: Sequence[str], series: list[tuple]) -> Column:
    """Whether a row belongs to one of the listed series (at most one per slice)."""
    if len(by) == 1 and all(key[0] is not None for key in series):
        return F.coalesce(F.col(by[0]).isin(*[key[0] for key in series]), F.lit(False))
    test = F.lit(False)
    for key in series:
        same = F.lit(True)
        for name, value in zip(by, key):
            same = same & F.col(name).eqNullSafe(F.lit(value))
        test = test | same
    return test


def _sorted(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def _without_nulls(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str], dict[str, Column]]:
    """Make the series columns non-null: a value in place of NULL, and a flag beside it.

    A join on such keys needs neither null-safe rewriting nor an added filter, so it uses the
    window's own partitioning and order, and both its sides read the same shuffle. Returns the
    rows, the keys, and how to get the columns back.
    """
    keys, back = [], {}
    for i, name in enumerate(by):
        field, flag = df.schema[name], f"_null{i}"
        keys.append(name)
        if not field.nullable:
            continue
        stand_in = "1970-01-01" if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "0"
        df = df.withColumn(flag, F.col(name).isNull())
        df = df.withColumn(name, F.coalesce(name, F.lit(stand_in).cast(field.dataType)))
        keys.append(flag)
        back[name] = F.when(~F.col(flag), F.col(name))
    return df, keys, back


def _first_row(columns: dict[str, str], order: Sequence[str], descending: bool) -> Column:
    """Struct of the columns on the first row along `order`, as an aggregate."""
    if set(columns.values()) == {order[0]}:  # a plain minimum keeps the hash aggregate
        end = F.max if descending else F.min
        return F.struct(*[end(c).alias(name) for name, c in columns.items()])
    picked = F.struct(*[F.col(c).alias(name) for name, c in columns.items()])
    return (F.max_by if descending else F.min_by)(picked, F.struct(*order))


def walk(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    *,
    totals: dict[str, str] | None = None,
    ahead: dict[str, str] | None = None,
    overall: dict[str, str] | None = None,
    descending: bool = False,
    **slicing,
) -> DataFrame:
    """Add values that depend on a row's place along `order` within its `by` series.

    Each argument maps a new column to the column it is made from: `totals` are inclusive running
    sums, `ahead` looks up the following row (NULL on the last one), `overall` is the sum of the
    whole series. `order` must be unique within a series. Equal to the window functions SUM and
    LEAD over (PARTITION BY by ORDER BY order), without ever holding a whole series in one task.
    """
    totals, ahead, overall = totals or {}, ahead or {}, overall or {}
    parts, several = slice_rows(df, order, by, **slicing)
    parts, keys, back = _without_nulls(parts, by)
    keys.append(SLICE)
    group = Window.partitionBy(*keys)
    local = group.orderBy(*_sorted(order, descending))
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = F.struct(*[F.col(c).alias(name) for name, c in ahead.items()])
    added = [F.sum(c).over(upto).alias(name) for name, c in totals.items()]
    if ahead:
        added.append(F.lead(picked).over(local).alias("_ahead"))
    added += [F.sum(c).over(group).alias(name) for name, c in overall.items()]
    out = parts.select("*", *added)
    if several:
        sums = {c: f"_add{i}" for i, c in enumerate(dict.fromkeys([*totals.values(), *overall.values()]))}
        facts = [F.sum(c).alias(name) for c, name in sums.items()]
        if ahead:
            facts.append(_first_row(ahead, order, descending).alias("_head"))
        # One row per slice of a series, so these windows are as short as the list of slices.
        series = Window.partitionBy(*(keys[:-1] or [F.lit(0)]))
        along = series.orderBy(*_sorted([SLICE], descending))
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        carried = [F.sum(sums[c]).over(before).alias(f"_carry{i}") for i, c in enumerate(totals.values())]
        carried += [F.sum(sums[c]).over(series).alias(f"_all{i}") for i, c in enumerate(overall.values())]
        if ahead:
            carried.append(F.lead("_head").over(along).alias("_after"))
        per_slice = parts.groupBy(*keys).agg(*facts)
        # Series that lie in one slice carry nothing, so what is joined stays as small as the cuts.
        carry = per_slice.select(*keys, F.count("*").over(series).alias("_slices"), *carried)
        out = out.join(carry.where("_slices > 1"), keys, "left")
        for i, name in enumerate(totals):
            out = out.withColumn(name, F.col(name) + F.coalesce(F.col(f"_carry{i}"), F.lit(0)))
        for i, name in enumerate(overall):
            out = out.withColumn(name, F.coalesce(f"_all{i}", name))
        if ahead:
            out = out.withColumn("_ahead", F.coalesce("_ahead", "_after"))
    looked_up = [F.col("_ahead")[name].alias(name) for name in ahead]
    kept = [back[c].alias(c) if c in back else F.col(c) for c in df.columns]
    return out.select(*kept, *totals, *looked_up, *overall)


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    *,
    ranks: Callable[[tuple, int], Sequence[float]] | None = None,
    facts: dict[str, Column] | None = None,
    accuracy: int = 10_000,
    **slicing,
) -> list[Row]:
    """Exact quantiles with linear interpolation, NULL and NaN ignored.

    A first pass counts each group and brackets every wanted rank by a sketch; a second one counts
    the values inside the brackets, and how many rows lie between them, and ranks those. A rank
    that turns out to lie outside its bracket makes its group be ranked as a whole.

    `ranks(group, n)` may state zero-based ranks itself; `probs` then only say where to look first.
    `facts` are further aggregates of the first pass. `by` has a bounded number of groups (columns,
    classes, models). Returns one row per group with a value: the `by` values, `n`, `q` with one
    value per probability, and the facts.
    """
    by, facts = list(by), facts or {}
    rows = df.withColumn("_v", _number(value))
    shape = rows.groupBy(*by).agg(
        F.count("_v").alias("n"), _sketch(F.col("_v"), probs, accuracy).alias("_s"), *[f.alias(n) for n, f in facts.items()]
    ).collect()
    groups = [_group(tuple(r[c] for c in by), r["n"], r["_s"], probs, ranks) for r in shape if r["n"]]
    held = rows.select(*by, "_v").where(F.col("_v").isNotNull())

    def counted(wanted: list[dict]) -> DataFrame:
        placed = _with_bounds(held, _bounds_frame(df, by, wanted), by)
        place = _placed(F.col("_v"), [(F.col("_lo")[j], F.col("_hi")[j], F.col("_gap")[j]) for j in range(len(probs))])
        return placed.select(*by, place.alias("_v")).groupBy(*by, "_v").agg(F.count("*").alias("_n"))

    found = _settle(counted, df, by, groups, len(probs), accuracy, slicing)
    more = {tuple(r[c] for c in by): {n: r[n] for n in facts} for r in shape}
    return [Row(**dict(zip(by, g["key"])), n=g["n"], q=found[g["key"]], **more[g["key"]]) for g in groups]


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], *, accuracy: int = 10_000, **slicing) -> dict[str, list[float]]:
    """As `quantiles`, of several columns side by side; columns without values are left out."""
    firsts = [f for i, c in enumerate(columns) for f in (F.count(_number(c)).alias(f"n{i}"), _sketch(_number(c), probs, accuracy).alias(f"s{i}"))]
    shape = df.agg(*firsts).first()
    groups = [_group((c,), shape[f"n{i}"], shape[f"s{i}"], probs, None) for i, c in enumerate(columns) if shape[f"n{i}"]]
    named = df.sparkSession.createDataFrame([], "column string")

    def counted(wanted: list[dict]) -> DataFrame:
        places = []
        for g in wanted:
            ends = [tuple(map(F.lit, x)) for x in zip(g["lo"], g["hi"], g["gap"])]
            places.append(F.struct(F.lit(g["key"][0]).alias("column"), _placed(_number(g["key"][0]), ends).alias("_v")))
        long = df.select(F.explode(F.array(*places)).alias("_p")).select("_p.column", "_p._v").where(F.col("_v").isNotNull())
        return long.groupBy("column", "_v").agg(F.count("*").alias("_n"))

    found = _settle(counted, named, ["column"], groups, len(probs), accuracy, slicing)
    return {key[0]: q for key, q in found.items()}


def _number(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None))


def _sketch(value: Column, probs: Sequence[float], accuracy: int) -> Column:
    """Values around each probability, three times the sketch's error to either side."""
    slack = 3.0 / accuracy
    around = [min(max(p + s, 0.0), 1.0) for p in probs for s in (-slack, slack)]
    return F.percentile_approx(value, F.array(*[F.lit(p) for p in around]), accuracy)


def _group(key: tuple, n: int, sketch: Sequence[float], probs: Sequence[float], ranks) -> dict:
    """A group's wanted ranks, the bracket of each, and the next number above each bracket."""
    wanted = list(ranks(key, n)) if ranks else [(n - 1) * p for p in probs]
    low, high = list(sketch[0::2]), list(sketch[1::2])
    return {"key": key, "n": n, "ranks": wanted, "lo": low, "hi": high, "gap": [math.nextafter(h, math.inf) for h in high]}


def _placed(value: Column, ends: list[tuple[Column, Column, Column]]) -> Column:
    """Values inside a bracket as they are; others become minus infinity or the number after the last bracket below them."""
    inside, gap = F.lit(False), F.lit(float("-inf"))
    for low, high, after in ends:
        inside = inside | value.between(low, high)
        gap = F.greatest(gap, F.when(value > high, after).otherwise(F.lit(float("-inf"))))
    return F.when(inside, value).when(value.isNotNull(), gap)


def _settle(counted: Callable[[list[dict]], DataFrame], df: DataFrame, by: list[str], groups: list[dict], probs: int,
            accuracy: int, slicing: dict) -> dict[tuple, list[float]]:
    """The quantiles of all groups: by their brackets, and as a whole where a rank lies elsewhere."""
    out: dict[tuple, list[float]] = {}
    expected = 8.0 / accuracy
    wanted = groups
    while wanted:
        n_rows = sum(math.ceil(min(g["n"], probs * (expected * g["n"] + 2))) for g in wanted)
        ranked = walk(counted(wanted), ["_v"], by, totals={"_upto": "_n"}, **{"n_rows": n_rows, **slicing})
        picks = []
        bounds = _bounds_frame(df, by, wanted)
        for j in range(probs):
            for k, name in enumerate(("f", "c")):
                picks.append(F.min(F.when(F.col("_upto") > F.col("_rank")[2 * j + k], F.col("_v"))).alias(f"_{name}{j}"))
        found = {tuple(r[c] for c in by): r for r in _with_bounds(ranked, bounds, by).groupBy(*by).agg(*picks).collect()}
        missed = []
        for g in wanted:
            r = found[g["key"]]
            ends = [(r[f"_f{j}"], r[f"_c{j}"]) for j in range(probs)]
            if all(g["lo"][j] <= x <= g["hi"][j] for j in range(probs) for x in ends[j]):
                out[g["key"]] = [_between(*ends[j], g["ranks"][j]) for j in range(probs)]
            else:
                whole = {"lo": [-math.inf] * probs, "hi": [math.inf] * probs, "gap": [math.inf] * probs}
                missed.append({**g, **whole})
        wanted, expected = missed, 1.0
    return out


def _between(low: float, high: float, rank: float) -> float:
    return low if low == high else low + (high - low) * (rank - math.floor(rank))


def _bounds_frame(df: DataFrame, by: list[str], groups: list[dict]) -> DataFrame:
    number = T.ArrayType(T.DoubleType())
    fields = [T.StructField(name, number) for name in ("_lo", "_hi", "_gap")]
    schema = T.StructType([*[df.schema[c] for c in by], *fields, T.StructField("_rank", T.ArrayType(T.LongType()))])
    data = [
        (*g["key"], *[[float(x) for x in g[name]] for name in ("lo", "hi", "gap")],
         [int(f(x)) for x in g["ranks"] for f in (math.floor, math.ceil)])
        for g in groups
    ]
    return df.sparkSession.createDataFrame(data, schema)


def _with_bounds(rows: DataFrame, bounds: DataFrame, by: list[str]) -> DataFrame:
    """Attach bounds, one row per group: literals if there is one group, else a small join."""
    if by:
        return _match(rows, F.broadcast(bounds), by)
    only = bounds.first()
    return rows.select(
        "*",
        *[F.array(*[F.lit(x) for x in only[c]]).alias(c) for c in ("_lo", "_hi", "_gap", "_rank")],
    )


def _match(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Inner join on `by`, NULL groups included."""
    if not by:
        only = right.first()
        return left.select("*", *[F.lit(only[c]).alias(c) for c in right.columns])
    names = {c: f"_m{i}" for i, c in enumerate(by)}
    renamed = right.withColumnsRenamed(names)
    on = F.lit(True)
    for name, other in names.items():
        on = on & left[name].eqNullSafe(renamed[other])
    return left.join(renamed, on).drop(*names.values())
