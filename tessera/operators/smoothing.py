"""Local regression: a loess curve per facet from counts per distinct x.

The data are first reduced to one row per distinct x (count and sum of y).
The curve is fitted at a fixed number of vertices per facet and continued
between them by cubics that meet its values and slopes. Radii of the
neighbourhoods are found exactly by rounds of counting in cells, the fits are
closed forms of weighted sums: everything is an aggregate with map-side
combine, no facet is sorted or gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.selection import on_keys
from tessera.session import cut_lineage

CELLS = 64


def _per_x(df: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    """One row per distinct x: ``_n`` rows with the sum ``_y``. Nulls and NaN of x or y are left out."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    src = df.where(xs.isNotNull() & ys.isNotNull() & ~F.isnan(xs) & ~F.isnan(ys))
    return src.groupBy(*keys, xs.alias("_x")).agg(F.count(F.lit(1)).alias("_n"), F.sum(ys).alias("_y"))


def _vertices(points: DataFrame, keys: Sequence[str], span: float, vertices: int) -> DataFrame:
    """Per facet and vertex its place ``_v``, the number ``_q`` of its nearest rows and bounds of their radius."""
    stats = points.groupBy(*keys).agg(F.sum("_n").alias("_all"), F.min("_x").alias("_min"), F.max("_x").alias("_max")) \
        .where(F.col("_all") > 0)
    i = F.explode(F.sequence(F.lit(0), F.lit(vertices - 1))).alias("i")
    placed = stats.select("*", i).withColumn("_v", F.col("_min") + F.col("i") * (F.col("_max") - F.col("_min")) / (vertices - 1))
    q = F.least(F.col("_all"), F.greatest(F.lit(1).cast("long"), F.floor(F.col("_all") * span + 1e-5)))
    return placed.select(*keys, "i", "_v", q.alias("_q"), F.lit(0.0).alias("_lo"),
                         F.greatest(F.col("_v") - F.col("_min"), F.col("_max") - F.col("_v")).alias("_hi"))


def _narrowed(points: DataFrame, open_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One round: the cell of distances that holds the ``_q``-th nearest row, as smallest and largest distance in it."""
    own = [*keys, "i"]
    near = on_keys(points.select(*keys, "_x", "_n"), open_, keys).withColumn("_d", F.abs(F.col("_x") - F.col("_v"))) \
        .where((F.col("_d") >= F.col("_lo")) & (F.col("_d") <= F.col("_hi")))
    width = (F.col("_hi") - F.col("_lo")) / CELLS
    cell = F.when(width <= 0, 0).otherwise(F.least(F.floor((F.col("_d") - F.col("_lo")) / width), F.lit(CELLS - 1))).cast("int")
    cells = near.groupBy(*own, "_v", "_q", cell.alias("_cell")).agg(
        F.sum("_n").alias("n"), F.min("_d").alias("lo"), F.max("_d").alias("hi"))
    ordered = cells.groupBy(*own, "_v", "_q").agg(F.array_sort(F.collect_list(F.struct("_cell", "n", "lo", "hi"))).alias("_cells"))
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))

    def step(state: Column, c: Column) -> Column:
        reached = state["lo"].isNotNull()
        here = ~reached & (state["before"] + c["n"] >= F.col("_q"))
        return F.struct(F.when(reached | here, state["before"]).otherwise(state["before"] + c["n"]).alias("before"),
                        F.when(here, c["lo"]).otherwise(state["lo"]).alias("lo"),
                        F.when(here, c["hi"]).otherwise(state["hi"]).alias("hi"))

    found = ordered.select(*own, "_v", "_q", F.aggregate("_cells", start, step).alias("_f"))
    return found.select(*own, "_v", (F.col("_q") - F.col("_f.before")).alias("_q"),
                        F.col("_f.lo").alias("_lo"), F.col("_f.hi").alias("_hi"))


def _radii(points: DataFrame, keys: Sequence[str], span: float, vertices: int) -> DataFrame:
    """``(keys.., i, _v, _h)``: distance of the ``floor(span n)``-th nearest row of every vertex, exactly.

    Each round cuts an open interval of distances into ``CELLS`` cells and goes
    on with the one that holds the wanted rank, until it holds one distance.
    The driver gets one number a round: how many vertices are still open.
    """
    open_, done = cut_lineage(_vertices(points, keys, span, vertices)), None
    while True:
        state = cut_lineage(_narrowed(points, open_, keys))
        settled = state.where(F.col("_lo") == F.col("_hi")).select(*keys, "i", "_v", F.col("_lo").alias("_h"))
        done = settled if done is None else done.unionByName(settled)
        open_ = state.where(F.col("_lo") < F.col("_hi"))
        if open_.isEmpty():
            return done


def _det(m: Sequence[Sequence[Column]]) -> Column:
    (a, b, c), (d, e, f), (g, h, i) = m
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def local_regression(df: DataFrame, x: str, y: str, by: Sequence[str] = (), span: float = 0.75,
                     vertices: int = 17) -> DataFrame:
    """Locally weighted quadratic regression (loess) at ``vertices`` equally spaced x of every facet.

    The neighbourhood of a vertex are the ``floor(span n)`` nearest rows, its
    radius the distance of the farthest of them; rows weigh by the tricube
    ``(1 - (d / radius)^3)^3``. With two distinct x inside the radius the fit is
    a line, with one their mean, with none (all nearest rows just as far) the
    mean of the nearest. Output ``(by.., i, x, fitted, slope)``; a facet
    without a row of both values gives none.
    """
    if not 0 < span <= 1 or vertices < 2:
        raise ValueError("span lies in (0, 1], vertices are at least 2")
    keys = list(by)
    points = cut_lineage(_per_x(df, x, y, keys))
    return _fitted(points, _radii(points, keys, span, vertices), keys)


def _fitted(points: DataFrame, radii: DataFrame, keys: Sequence[str]) -> DataFrame:
    near = on_keys(points, cut_lineage(radii), keys).withColumn("_d", F.abs(F.col("_x") - F.col("_v"))) \
        .where(F.col("_d") <= F.col("_h"))
    u = F.when(F.col("_h") > 0, (F.col("_x") - F.col("_v")) / F.col("_h")).otherwise(F.lit(0.0))
    tricube = F.when(F.col("_d") < F.col("_h"), F.pow(1 - F.pow(F.col("_d") / F.col("_h"), F.lit(3.0)), F.lit(3.0))).otherwise(0.0)
    near = near.withColumns({"_u": u, "_w": tricube})
    mass, total = F.col("_w") * F.col("_n"), F.col("_w") * F.col("_y")
    power = [F.lit(1.0)]
    for _ in range(4):
        power.append(power[-1] * F.col("_u"))
    sums = near.groupBy(*keys, "i", "_v", "_h").agg(
        F.count_if(F.col("_w") > 0).alias("_k"), F.sum("_n").alias("_m"), F.sum("_y").alias("_t"),
        *[F.sum(mass * power[j]).alias(f"_s{j}") for j in range(5)], *[F.sum(total * power[j]).alias(f"_t{j}") for j in range(3)])
    s, t = [F.col(f"_s{j}") for j in range(5)], [F.col(f"_t{j}") for j in range(3)]
    whole = _det([s[0:3], s[1:4], s[2:5]])
    flat = s[0] * s[2] - s[1] * s[1]
    value = (F.when(F.col("_k") >= 3, F.try_divide(_det([[t[0], s[1], s[2]], [t[1], s[2], s[3]], [t[2], s[3], s[4]]]), whole))
             .when(F.col("_k") == 2, F.try_divide(t[0] * s[2] - t[1] * s[1], flat))
             .when(F.col("_k") == 1, t[0] / s[0]).otherwise(F.col("_t") / F.col("_m")))
    slope = (F.when(F.col("_k") >= 3, F.try_divide(_det([[s[0], t[0], s[2]], [s[1], t[1], s[3]], [s[2], t[2], s[4]]]), whole * F.col("_h")))
             .when(F.col("_k") == 2, F.try_divide(s[0] * t[1] - s[1] * t[0], flat * F.col("_h"))).otherwise(F.lit(0.0)))
    return sums.select(*keys, "i", F.col("_v").alias("x"), value.alias("fitted"), slope.alias("slope"))


def smoothed(rows: DataFrame, curve: DataFrame, x: str, by: Sequence[str] = (), name: str = "smooth") -> DataFrame:
    """``rows`` with the value of ``local_regression``'s curve at their ``x``, by cubics between its vertices.

    The curve is one array of vertices per facet. Null where x is null or
    outside the facet's vertices, or the facet has no curve.
    """
    keys = list(by)
    packed = curve.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        F.col("i"), F.col("x").alias("v"), F.col("fitted").alias("f"), F.col("slope").alias("s")))).alias("_curve"))
    out = on_keys(rows, cut_lineage(packed), keys) if keys else rows.crossJoin(F.broadcast(packed))
    at, last = F.col(x).cast("double"), F.size("_curve") - 1
    first, end = F.col("_curve")[0]["v"], F.element_at("_curve", -1)["v"]
    step = (end - first) / last
    cell = F.when(step > 0, F.least(F.floor((at - first) / step).cast("int"), last - 1)).otherwise(F.lit(0))
    out = out.withColumn("_step", step).withColumn("_cell", F.when((at >= first) & (at <= end), cell)) \
        .withColumns({"_a": F.get("_curve", F.col("_cell")), "_b": F.get("_curve", F.col("_cell") + 1)})
    t = F.when(F.col("_step") > 0, (at - F.col("_a.v")) / F.col("_step")).otherwise(F.lit(0.0))
    out = out.withColumn("_p", t)
    p = F.col("_p")
    cubic = (F.col("_a.f") * (2 * p * p * p - 3 * p * p + 1) + F.col("_a.s") * F.col("_step") * (p * p * p - 2 * p * p + p)
             + F.col("_b.f") * (3 * p * p - 2 * p * p * p) + F.col("_b.s") * F.col("_step") * (p * p * p - p * p))
    return out.withColumn(name, cubic).drop("_curve", "_step", "_cell", "_a", "_b", "_p")
