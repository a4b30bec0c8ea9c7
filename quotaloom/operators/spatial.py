"""Boxes, points and polygons (survey J7-J9, N9, N10, A25, P15, P17).

Range joins go through a grid: boxes are cut into the grid cells they touch, points are keyed by their cell, and an equi-join on
the cell replaces the nested loop. Only the exact test then sees the candidates.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coordinate(own: Column, centre: Column) -> Column:
    """P15."""
    return F.coalesce(own, centre)


def inside_box(x: Column, y: Column, box: dict[str, Column]) -> Column:
    """P17, borders included."""
    return x.between(box["x0"], box["x1"]) & y.between(box["y0"], box["y1"])


def grid_join(points: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    """All pairs of a point (x, y) and a box (x0, y0, x1, y1) that holds it."""
    cell = lambda c: F.floor(c / size)
    b = boxes.withColumn("_cx", F.explode(F.sequence(cell(F.col("x0")), cell(F.col("x1"))))).withColumn("_cy", F.explode(F.sequence(cell(F.col("y0")), cell(F.col("y1")))))
    p = points.withColumn("_cx", cell(F.col("x"))).withColumn("_cy", cell(F.col("y")))
    hit = inside_box(F.col("x"), F.col("y"), {k: F.col(k) for k in ("x0", "y0", "x1", "y1")})
    return p.join(b, ["_cx", "_cy"]).filter(hit).drop("_cx", "_cy")


def nearest_box(points: DataFrame, boxes: DataFrame, point_id: str, box_id: str, size: float, occurs: DataFrame | None = None) -> DataFrame:
    """Of the boxes that hold a point, the one with the nearest centre; ties go to the smaller id.

    ``occurs`` (point_id, box_id) names the boxes in whose files a point was found: such a point takes the nearest of these, whether the
    box holds it or not; points without one are left to the boxes that hold them.
    """
    near = F.struct(F.round(_distance(), 12).alias("d"), F.col(box_id).alias(box_id))
    if occurs is None:
        return grid_join(points, boxes, size).groupBy(point_id).agg(F.min(near)[box_id].alias(box_id))
    known = points.join(occurs, point_id).join(boxes, box_id)
    free = grid_join(points.join(occurs, point_id, "left_anti"), boxes, size)
    cols = [point_id, "x", "y", box_id, "x0", "y0", "x1", "y1"]
    return known.select(*cols).unionByName(free.select(*cols)).groupBy(point_id).agg(F.min(near)[box_id].alias(box_id))


def _distance() -> Column:
    """N9."""
    dx, dy = F.col("x") - (F.col("x0") + F.col("x1")) / 2, F.col("y") - (F.col("y0") + F.col("y1")) / 2
    return dx * dx + dy * dy


def inside_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd ray casting over the edges of all rings of an area, each an array of (x, y) points; so a ring within a ring is a hole, and
    islands count."""

    def crossings(ring: Column) -> Column:
        n = F.size(ring)

        def crosses(i: Column) -> Column:
            a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, n))
            straddles = (a["y"] > y) != (b["y"] > y)
            at = (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] != a["y"], b["y"] - a["y"]) + a["x"]
            return F.when(straddles & (x < at), 1).otherwise(0)

        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + crosses(i))

    return F.aggregate(rings, F.lit(0), lambda acc, ring: acc + crossings(ring)) % 2 == 1


def stitch_rings(ways: DataFrame, area_id: str) -> DataFrame:
    """(area_id, rings) from the ways (area_id, way, points) of each area's border.

    Closed ways are rings; open ones are joined at equal ends, in the order of their numbers and turned round where needed, until
    they close. Chains that don't close, and rings of fewer than four points, are left out. One area's border is one group; it is a
    bounded thing, unlike the points inside.
    """
    points = "array<array<struct<x:double,y:double>>>"

    def run(key, pdf):
        open_, rings = [], []
        for way in pdf.sort_values("way")["points"]:
            line = [(p["x"], p["y"]) for p in way]
            (rings if len(line) > 1 and line[0] == line[-1] else open_).append(line)
        while open_:
            line, joined = open_.pop(0), True
            while line[0] != line[-1] and joined:
                joined = False
                for k, other in enumerate(open_):
                    if line[-1] in (other[0], other[-1]):
                        line += (other if other[0] == line[-1] else other[::-1])[1:]
                        del open_[k]
                        joined = True
                        break
            if line[0] == line[-1]:
                rings.append(line)
        kept = [[{"x": x, "y": y} for x, y in r] for r in rings if len(r) >= 4]
        return pd.DataFrame({area_id: [key[0]], "rings": [kept]})

    kind = ways.schema[area_id].dataType.simpleString()
    return ways.groupBy(area_id).applyInPandas(run, f"{area_id} {kind}, rings {points}").filter(F.size("rings") > 0)


def locate(points: DataFrame, areas: DataFrame, point_id: str, area_id: str, size: float) -> DataFrame:
    """The smallest id of the areas (with ``rings``) that hold each point; points in none are left out."""
    all_points = F.flatten("rings")
    xs, ys = F.transform(all_points, lambda q: q["x"]), F.transform(all_points, lambda q: q["y"])
    boxed = areas.select(area_id, "rings", F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
    j = grid_join(points, boxed, size).filter(inside_rings(F.col("x"), F.col("y"), F.col("rings")))
    return j.groupBy(point_id).agg(F.min(area_id).alias(area_id))


def by_elimination(located: DataFrame, members: DataFrame, known: DataFrame, group: str, item: str) -> DataFrame:
    """Items without an area take their group's only member that has no area; others stay null.

    ``located``: (group, item key..., member?); ``members``: (group, member); ``known``: (group, member) with an area.
    """
    missing = members.join(known, [group, item], "left_anti").groupBy(group).agg(F.count("*").alias("_n"), F.min(item).alias("_only"))
    out = located.join(missing, group, "left")
    return out.withColumn(item, F.coalesce(F.col(item), F.when(F.col("_n") == 1, F.col("_only")))).drop("_n", "_only")


def bounds(df: DataFrame, group: str) -> DataFrame:
    """Box and centre of each group's points."""
    g = df.groupBy(group).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    return g.withColumn("cx", (F.col("x0") + F.col("x1")) / 2).withColumn("cy", (F.col("y0") + F.col("y1")) / 2)


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))
