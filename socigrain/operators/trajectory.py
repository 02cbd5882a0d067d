"""Trajectories: rolling measures, distances, contacts.

Frames of an entity are consecutive integers.  Rolling operators cut an entity's frames in
blocks and give each block the frames before it that its windows reach, so that one long
trajectory is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.numbers import euclid
from ..session import cut
from .contact_cells import FRAMES, Cells
from .rolling import rolling_moments, rolling_quantiles
from .skew import lookup_join, number_rows

BLOCK = 100_000


def with_halo(traj: DataFrame, reach: int, block: int = BLOCK) -> DataFrame:
    """Add ``_block``/``_own``; rows within ``reach`` frames before a block are copied into it.

    A reach beyond the block copies a row into every block that looks back on it.
    """
    home = F.floor(F.col("frame") / block)
    copies = traj.withColumn("_home", home).withColumn(
        "_block", F.explode(F.sequence(F.col("_home"), F.floor((F.col("frame") + reach) / block)))
    )
    return copies.withColumn("_own", F.col("_block") == F.col("_home")).drop("_home")


def block_of(window: int) -> int:
    """Block for a window: no smaller than the window, so that a row is copied once at most."""
    return max(BLOCK, window)


def without_halo(df: DataFrame) -> DataFrame:
    return df.filter("_own").drop("_own", "_block")


def _w():
    return W.partitionBy("entity", "_block").orderBy("frame")


def differences(traj: DataFrame, cols: Sequence[str], n: int = 1, block: int | None = None) -> DataFrame:
    """``<c>_diff`` = value minus the value n frames earlier; null for the first n."""
    d = with_halo(traj, n, block or block_of(n))
    return without_halo(d.withColumns({f"{c}_diff": F.col(c) - F.lag(c, n).over(_w()) for c in cols}))


def path_values(traj: DataFrame, window: int, block: int | None = None) -> DataFrame:
    """Step, straight and real path length over ``window`` frames, straightness and axis changes."""
    d = with_halo(traj, window, block or block_of(window))
    w = _w()
    rolling = w.rowsBetween(-(window - 1), 0)

    def back(c: str, n: int) -> Column:
        return F.col(c) - F.lag(c, n).over(w)

    d = d.withColumns({"_dx": back("pos_x", 1), "_dy": back("pos_y", 1),
                       "_wx": back("pos_x", window), "_wy": back("pos_y", window)})
    d = d.withColumns({"step": euclid(F.col("_dx"), F.col("_dy")), "spl": euclid(F.col("_wx"), F.col("_wy"))})
    full = F.count("step").over(rolling) == window
    d = d.withColumn("rpl", F.when(full, F.sum("step").over(rolling)))
    d = d.withColumns({"str_index": F.try_divide("spl", "rpl"),
                       "abs_change_x": F.abs("_wx"), "abs_change_y": F.abs("_wy")})
    filled = ["step", "spl", "rpl", "str_index", "abs_change_x", "abs_change_y"]
    out = d.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in filled})
    return without_halo(out).drop("_dx", "_dy", "_wx", "_wy")


#: Windows of up to this many frames are sorted anew for each frame, inside Spark's window operator.
SHORT = 32
#: Measures of ``rolling_descriptor`` in column order; a number is the quantile.
DESCRIPTOR = {"min": 0.0, "max": 1.0, "mean": None, "median": 0.5, "std": None, "p10": 0.1, "p25": 0.25, "p75": 0.75, "p90": 0.9}


def rolling_descriptor(traj: DataFrame, value: str, window: int, block: int | None = None) -> DataFrame:
    """min, max, mean, median, sample std, p10..p90 over full windows; null before the first one.

    A window with a null or NaN has null measures; the standard deviation of one frame is null.  All columns
    are kept.  Over a window of more than ``SHORT`` frames a block is run through once: a sorted window takes
    one value in and lets one go per frame, and sums come from pieces of a window's length.
    """
    d = with_halo(traj, window - 1, block or block_of(window)).withColumn("_x", F.nanvl(F.col(value).cast("double"), F.lit(None)))
    if window <= SHORT:
        return without_halo(_sorted_anew(d, value, window)).drop("_x")
    names = [f"{value}_{n}" for n in DESCRIPTOR]
    kept = [f for f in d.schema.fields if f.name not in ("_x", "_own", "_block")]
    schema = StructType([*kept, *[StructField(n, DoubleType()) for n in names]])

    def describe(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("frame")
        x = rows["_x"].to_numpy(zero_copy_only=False).astype(float)
        mean, std = rolling_moments(x, window)
        quantiles = rolling_quantiles(x, window, [q for q in DESCRIPTOR.values() if q is not None])
        measures = {"mean": mean, "std": std} | dict(zip((n for n, q in DESCRIPTOR.items() if q is not None), quantiles))
        out = rows.select([f.name for f in kept])
        for name, measure in DESCRIPTOR.items():
            out = out.append_column(f"{value}_{name}", pa.array(measures[name], from_pandas=True))
        return out.filter(rows["_own"])

    return d.groupBy("entity", "_block").applyInArrow(describe, schema)


def _sorted_anew(d: DataFrame, value: str, window: int) -> DataFrame:
    frame = _w().rowsBetween(-(window - 1), 0)
    x = F.col("_x")
    others = {"mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
    measures = {n: others[n] if n in others else F.percentile(x, F.lit(q)) for n, q in DESCRIPTOR.items()}
    full = F.count(x).over(frame) == window
    return d.withColumns({f"{value}_{n}": F.when(full, m.over(frame)) for n, m in measures.items()})


def forward_fill(traj: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Last non-null value per entity; only one carried value per block crosses blocks."""
    blocked = traj.withColumn("_block", F.floor(F.col("frame") / block))
    tails = blocked.groupBy("entity", "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("frame"))).alias(c) for c in cols]
    )
    earlier = W.partitionBy("entity").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = tails.select(
        "entity", "_block", *[F.last(c, ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in cols]
    )
    inside = W.partitionBy("entity", "_block").orderBy("frame").rowsBetween(W.unboundedPreceding, 0)
    filled = blocked.withColumns({f"_fill_{c}": F.last(c, ignorenulls=True).over(inside) for c in cols})
    joined = filled.join(carried, ["entity", "_block"], "left")
    joined = joined.withColumns({c: F.coalesce(f"_fill_{c}", f"_carry_{c}") for c in cols})
    return joined.drop("_block", *[f"_fill_{c}" for c in cols], *[f"_carry_{c}" for c in cols])


def population_minima(traj: DataFrame) -> DataFrame:
    return traj.agg(F.min("pos_x").alias("min_x"), F.min("pos_y").alias("min_y"))


def shift_to_origin(traj: DataFrame) -> DataFrame:
    """Subtract the population's smallest x and y."""
    return traj.withColumns(
        {c: F.col(c) - traj.select(F.min(c)).scalar() for c in ("pos_x", "pos_y")}
    )


def acceleration(traj: DataFrame, velocity: str = "velocity", block: int | None = None) -> DataFrame:
    """Successive velocity differences: one row fewer than frames per entity."""
    d = differences(traj, [velocity], 1, block)
    return d.filter(F.col("frame") > 0).select(
        "entity", (F.col("frame") - 1).alias("frame"), F.col(f"{velocity}_diff").alias("acceleration")
    )


def coordinates_union(traj: DataFrame) -> DataFrame:
    return traj.select("pos_x", "pos_y").dropna()


#: Frames of an entity that travel as one row.
PIECE = 32


def _pieces(traj: DataFrame, side: str) -> DataFrame:
    """(entity, piece, has, xs, ys) of one side: positions by place in the piece, ``has`` tells which frames exist.

    A frame given several times has its rows in several pieces, so that each meets each.
    """
    again = W.partitionBy("entity", "frame").orderBy("pos_x", "pos_y")
    placed = traj.filter(F.col("frame").isNotNull()).select(
        "entity", F.floor(F.col("frame") / PIECE).alias("_piece"), F.pmod("frame", F.lit(PIECE)).cast("int").alias("_slot"),
        F.row_number().over(again).alias("_again"), F.struct("pos_x", "pos_y").alias("_pos"),
    )
    rows = placed.groupBy("entity", "_piece", "_again").agg(
        F.bit_or(F.expr("shiftleft(1L, _slot)")).alias(f"_has_{side}"),
        F.map_from_entries(F.collect_list(F.struct("_slot", "_pos"))).alias("_at"),
    )
    at = F.transform(F.sequence(F.lit(0), F.lit(PIECE - 1)), lambda i: F.col("_at")[i])
    return rows.select(
        F.col("entity").alias(f"entity_{side}"), "_piece", f"_has_{side}",
        F.transform(at, lambda p: p["pos_x"]).alias(f"_{side}x"), F.transform(at, lambda p: p["pos_y"]).alias(f"_{side}y"),
    )


def pair_distances(traj: DataFrame, pairs: DataFrame) -> DataFrame:
    """(entity_a, entity_b, frame, dist) for the given pairs, on every frame both have.

    ``pairs`` holds (entity_a, entity_b), a < b.  The caller chooses them: the result is as
    long as the pairs' common frames.  A pair carries pieces of ``PIECE`` positions of its first entity
    to the second, and frames become rows only where both have met.
    """
    wanted = pairs.select("entity_a", "entity_b").distinct()
    both = wanted.join(_pieces(traj, "a"), "entity_a", "inner").join(_pieces(traj, "b"), ["entity_b", "_piece"], "inner")
    common = both.withColumn("_has", F.col("_has_a").bitwiseAND(F.col("_has_b"))).filter("_has <> 0")
    slots = common.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(PIECE - 1)))).filter("(shiftrightunsigned(_has, _slot) & 1L) = 1L")
    gap = [F.col(f"_a{c}")[F.col("_slot")] - F.col(f"_b{c}")[F.col("_slot")] for c in "xy"]
    return slots.select(
        "entity_a", "entity_b", (F.col("_piece") * PIECE + F.col("_slot")).alias("frame"), euclid(*gap).alias("dist"),
    )


def near_pairs(traj: DataFrame, limit: float) -> DataFrame:
    """Every (entity_a < entity_b, frame, dist) with dist <= limit, exactly.

    Positions fall in square cells of side ``limit``; a point only meets the points of its own
    cell and of four of the eight neighbours (the other four meet it from their side), so far
    pairs are never formed and near pairs once.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(float(limit)))
    pts = traj.filter(F.col("pos_x").isNotNull() & F.col("pos_y").isNotNull()).select(
        "frame", cell("pos_x").alias("_cx"), cell("pos_y").alias("_cy"), "entity", "pos_x", "pos_y"
    )
    steps = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))])
    a = pts.withColumn("_s", F.explode(steps)).select(
        "frame", (F.col("_cx") + F.col("_s.x")).alias("_cx"), (F.col("_cy") + F.col("_s.y")).alias("_cy"),
        ((F.col("_s.x") == 0) & (F.col("_s.y") == 0)).alias("_own"),
        F.col("entity").alias("_a"), F.col("pos_x").alias("ax"), F.col("pos_y").alias("ay"),
    )
    b = pts.select("frame", "_cx", "_cy", F.col("entity").alias("_b"), F.col("pos_x").alias("bx"), F.col("pos_y").alias("by"))
    dist = euclid(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by"))
    once = F.when(F.col("_own"), F.col("_a") < F.col("_b")).otherwise(F.col("_a") != F.col("_b"))
    return (
        lookup_join(a, b, ["frame", "_cx", "_cy"], "inner")
        .filter(once & (dist <= limit))
        .select(F.least("_a", "_b").alias("entity_a"), F.greatest("_a", "_b").alias("entity_b"), "frame", dist.alias("dist"))
    )


def contact_runs(near: DataFrame, min_frames: int, block: int = BLOCK) -> DataFrame:
    """Islands of consecutive near frames of a pair lasting at least ``min_frames``."""
    pair = ["entity_a", "entity_b"]
    cell = [*pair, "_block"]
    inside = W.partitionBy(*cell).orderBy("frame")
    runs = (
        near.withColumn("_block", F.floor(F.col("frame") / block))
        .withColumn("_island", F.col("frame") - F.row_number().over(inside))
        .groupBy(*cell, "_island")
        .agg(F.min("frame").alias("start"), F.max("frame").alias("end"))
    )
    # Only runs that touch the edge of a block can go on in the next one: at most two per block.
    # Every other run is its own window partition and, if too short, is dropped here.
    first = F.col("_block") * block
    edge = (F.col("start") == first) | (F.col("end") == first + block - 1)
    runs = runs.withColumns({"_edge": edge, "_own": F.when(~edge, F.col("start"))})
    runs = runs.filter(F.col("_edge") | (F.col("end") - F.col("start") + 1 >= min_frames))
    group = [*pair, "_edge", "_own"]
    along = W.partitionBy(*group).orderBy("start")
    fresh = F.coalesce((F.col("start") > F.lag("end").over(along) + 1).cast("int"), F.lit(1))
    merged = (
        runs.withColumn("_f", fresh).withColumn("_run", F.sum("_f").over(along))
        .groupBy(*group, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select(*pair, "start", "end")
    )
    return merged.withColumn("frames", F.col("end") - F.col("start") + 1).filter(F.col("frames") >= min_frames)


#: Entities that share a frame and a grid cell with one, on average, up to which near frames travel as rows.
NEIGHBOURS = 8


def _crowded(traj: DataFrame, limit: float, neighbours: int = NEIGHBOURS) -> DataFrame | None:
    """The usable positions, stored, if pairs of them meet too often to be rows; else None.

    An entity that has a frame twice also gives None: its near frames are counted as rows.
    """
    wanted = F.col("entity").isNotNull() & F.col("frame").isNotNull() & F.col("pos_x").isNotNull() & F.col("pos_y").isNotNull()
    points = cut(traj.filter(wanted).select("entity", "frame", "pos_x", "pos_y"), "points")
    grid = points.groupBy("frame", *[F.floor(F.col(c) / F.lit(float(limit))) for c in ("pos_x", "pos_y")]).agg(F.count(F.lit(1)).cast("double").alias("n"))
    rows, met = grid.agg(F.sum("n"), F.sum(F.col("n") * F.col("n"))).first()
    if not rows or met <= neighbours * rows:
        return None
    return points if points.groupBy("entity", "frame").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty() else None


def _merged_open(cells: Cells, min_frames: int) -> DataFrame:
    """Runs over several blocks: pieces that follow each other without a gap are one."""
    pair = ["entity_a", "entity_b"]
    along = W.partitionBy(*pair).orderBy("start")
    fresh = F.coalesce((F.col("start") > F.lag("end").over(along) + 1).cast("int"), F.lit(1))
    runs = cells.over("open").withColumn("_f", fresh).withColumn("_run", F.sum("_f").over(along))
    merged = runs.groupBy(*pair, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")
    return merged.filter(F.col("end") - F.col("start") + 1 >= min_frames)


def contacts(traj: DataFrame, distance: float, min_frames: int, neighbours: int = NEIGHBOURS, block: int = FRAMES) -> DataFrame:
    """Contact runs of all pairs: within ``distance`` + 1 for at least ``min_frames`` frames.

    Where few meet, near frames are rows of a grid join; where entities crowd, groups of them meet in cells of
    ``block`` frames and only positions are moved.  The runs are the same.
    """
    points = _crowded(traj, distance + 1, neighbours)
    if points is None:
        return contact_runs(near_pairs(traj, distance + 1), min_frames)
    cells = Cells(points, distance + 1, min_frames, block)
    runs = cells.over("runs")
    if not cells.one_block:
        runs = runs.unionByName(_merged_open(cells, min_frames))
    return runs.withColumn("frames", F.col("end") - F.col("start") + 1)


def contact_totals(traj: DataFrame, distance: float, min_frames: int, neighbours: int = NEIGHBOURS, block: int = FRAMES) -> DataFrame:
    """(entity_a, entity_b, count, frames): number and length of a pair's contact runs, without its runs as rows."""
    points = _crowded(traj, distance + 1, neighbours)
    if points is None:
        return _totals(contact_runs(near_pairs(traj, distance + 1), min_frames).withColumn("count", F.lit(1)))
    cells = Cells(points, distance + 1, min_frames, block)
    inside = cells.over("totals")
    if cells.one_block:
        return inside
    open_ = _merged_open(cells, min_frames).select(
        "entity_a", "entity_b", F.lit(1).cast("long").alias("count"), (F.col("end") - F.col("start") + 1).alias("frames")
    )
    return _totals(inside.unionByName(open_))


def _totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("entity_a", "entity_b").agg(F.sum("count").alias("count"), F.sum("frames").alias("frames"))


def _rates(duration: Column, count: Column) -> dict[str, Column]:
    return {
        "frequency": count / duration / F.lit(0.5),
        "averaging": F.lit(1 / 599.5) * (duration / count - F.lit(0.5)),
    }


def contact_edges(runs: DataFrame, fps: float) -> DataFrame:
    """One weighted edge per pair: count, duration in seconds, frequency and averaging."""
    return edges_of_totals(runs.groupBy("entity_a", "entity_b").agg(F.count(F.lit(1)).alias("count"), F.sum("frames").alias("frames")), fps)


def edges_of_totals(totals: DataFrame, fps: float) -> DataFrame:
    """``contact_edges`` from the totals of each pair (``contact_totals``)."""
    e = totals.select(
        F.col("entity_a").alias("src"), F.col("entity_b").alias("dst"), "count", (F.col("frames") / F.lit(float(fps))).alias("duration")
    )
    return e.withColumns(_rates(F.col("duration"), F.col("count")))


def contact_multi_edges(runs: DataFrame) -> DataFrame:
    return runs.select(F.col("entity_a").alias("src"), F.col("entity_b").alias("dst"), F.col("frames").alias("duration"))


def contact_intervals(runs: DataFrame) -> DataFrame:
    return runs.select(F.col("entity_a").alias("src"), F.col("entity_b").alias("dst"), "start", "end")


def collapse_multi_edges(multi: DataFrame, fps: float) -> DataFrame:
    """Parallel edges to one weighted edge; zero-duration edges are skipped, all are in seconds."""
    e = (
        multi.filter(F.col("duration") > 0)
        .groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.count(F.lit(1)).alias("count"), (F.sum("duration") / F.lit(float(fps))).alias("duration"))
    )
    return e.withColumns(_rates(F.col("duration"), F.col("count")))


def collapsed_contacts(totals: DataFrame, fps: float) -> DataFrame:
    """``collapse_multi_edges`` of the contacts' parallel edges, from the totals of each pair (``contact_totals``).

    A run lasts a frame at least, so none of its edges has zero duration.
    """
    return edges_of_totals(totals, fps)


def relabel_groups(entities: DataFrame, control_prefix: str = "CTRL", order: str = "name") -> DataFrame:
    """Number populations per group in order: CTRL_1, CTRL_2, ..., COC_1, ..."""
    group = F.when(F.col("name").startswith(control_prefix), F.lit(control_prefix)).otherwise(F.lit("COC"))
    grouped = entities.withColumn("group", group)
    numbered = number_rows(grouped, ["group"], [order], F.substring(order, 1, 8), "_n")
    return numbered.withColumn("label", F.concat_ws("_", "group", F.col("_n").cast("string"))).drop("_n")


def group_values(measures: DataFrame, population: str = "population") -> DataFrame:
    """Long (group, value): COC populations against all others."""
    return measures.withColumn("group", F.when(F.col(population).startswith("COC"), "COC").otherwise("CTRL"))
