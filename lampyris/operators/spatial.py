"""Spatial joins as grid-cell equi joins.

Nothing here plans a nested loop over two tables that both grow: the smaller geometry is covered by
grid cells, the cells are joined by equality, and the exact predicate runs on the few candidates.
Catalyst broadcasts a side only when its statistics are below ``autoBroadcastJoinThreshold``; otherwise
the joins shuffle on the cell and AQE splits the partitions of crowded cells.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions import geo
from . import rings

# Cells of level 0; a level's cells have four times the side of the level below. Any level may occur, also negative ones.
CELL_DEG = 0.02
COVER_CELLS = 16
# Shapes below that size are covered by about this many cells per axis.
SMALL_COVER_CELLS = 2
# The finest cells, about a metre: smaller shapes share them.
FINEST_LEVEL = -6
# Beyond this cell size the corner and clamping tests of a circle's cells are not safe on the sphere.
NEAR_CELL_DEG = 0.5
CELL = ["_lv", "_cx", "_cy"]
# Radius joins: tasks for each core, and pairs measured at once.
TASKS_PER_CORE = 4
PAIR_BLOCK = 1 << 17
# Points whose pairs with a block of circles come out together: their ids recur at short distance, which files store in fewer bytes.
SPOT_BLOCK = 256
# Up to so many circles all cells' points are dealt to so many tasks; beyond that crowded cells are counted.
FEW_CIRCLES = 4096
POINT_SHARES = 4

# Right rows that share a finest cell of the k-nearest join (the mean over rows), and how much finer left blocks are.
KNN_ROWS_PER_LEAF = 8
KNN_FINER = 3
# Deepest split of the right side's extent: under a metre for a globe. Rows closer than that share a cell.
KNN_DEEPEST = 26
# A right side of up to so many rows goes to every task as two arrays of numbers.
KNN_SMALL = 4096
_BOUND_SLACK = 1e-9


def _floor(value: Column) -> Column:
    return F.floor(value).cast("bigint")


# -------------------------------------------------------------------------------- grid levels
#
# A shape is covered by cells of its own level, which follows its size: about COVER_CELLS cells per axis for large
# shapes (more for rings of many edges), few for small ones. The levels that occur among the shapes (one small aggregate) are the ones at which points
# are looked up; a point is repeated once for each of them, which is once or twice unless sizes differ a lot.


def _level_with(span: Column, cells: Column | float) -> Column:
    """The level at which a span has about so many cells, at least a quarter of them."""
    return F.ceil(F.log(F.greatest(span, F.lit(1e-12)) / (cells * CELL_DEG)) / math.log(4))


def _level_of(span: Column) -> Column:
    large, small = _level_with(span, COVER_CELLS), _level_with(span, SMALL_COVER_CELLS)
    return F.greatest(F.when(large > 0, large).otherwise(F.least(small, F.lit(0))), F.lit(FINEST_LEVEL)).cast("int")


def _size(level: Column) -> Column:
    return F.lit(CELL_DEG) * F.pow(F.lit(4.0), level)


def _with_cells(points: DataFrame, levels: list[int]) -> DataFrame:
    """Points with ``_lv``, ``_cx``, ``_cy``: one row per level."""
    spots = [
        F.struct(
            F.lit(n).alias("_lv"),
            _floor(F.col("lon") / (CELL_DEG * 4.0**n)).alias("_cx"),
            _floor(F.col("lat") / (CELL_DEG * 4.0**n)).alias("_cy"),
        )
        for n in levels
    ]
    if len(levels) == 1:
        return points.select("*", *[spots[0][f].alias(f) for f in CELL])
    return points.select("*", F.inline(F.array(*spots)))


# -------------------------------------------------------------------------------- containment


def shaped_rings(zones: DataFrame) -> DataFrame:
    """Zones with their box, level, cell size and edges in place of the ring."""
    rest = [c for c in zones.columns if c != "ring"]
    ends = [f"array_{f}(transform(ring, p -> p.{c})) as {f}_{c}" for f in ("min", "max") for c in ("lon", "lat")]
    boxed = zones.where("size(ring) > 1").selectExpr("*", f"inline(array(struct({', '.join(ends)})))")
    span = "greatest(max_lon - min_lon, max_lat - min_lat, 1e-12D)"
    at = lambda cells: f"ceil(ln({span} / ({cells} * {CELL_DEG}D)) / ln(4))"
    level = f"greatest(if({at(COVER_CELLS)} > 0, {at(COVER_CELLS)}, least({at(SMALL_COVER_CELLS)}, 0)), {FINEST_LEVEL})"
    # rings of many edges have about as many cells as edges, so that a rim cell holds few of them
    finer = f"if(size(ring) > {COVER_CELLS**2}, greatest(least({level}, {at('sqrt(size(ring))')}), {FINEST_LEVEL}), {level})"
    edges = "transform(slice(ring, 1, size(ring) - 1), (p, i) -> struct(p.lon as x1, p.lat as y1, ring[i + 1].lon as x2, ring[i + 1].lat as y2))"
    box = "struct(min_lon, min_lat, max_lon, max_lat) as _b"
    shaped = boxed.selectExpr(*rest, box, f"inline(array(struct(cast({finer} as int) as _lv, {edges} as _edges)))")
    return shaped.selectExpr("*", f"{CELL_DEG}D * pow(4D, _lv) as _size")


def _zone_cover(shaped: DataFrame, large: bool) -> DataFrame:
    few = F.size("_edges") <= rings.SMALL_RING
    if not large:
        return rings.small_cover(shaped)
    return rings.small_cover(shaped.where(few)).unionByName(rings.large_cover(shaped.where(~few)))


def zone_cover(zones: DataFrame) -> DataFrame:
    """One row per (zone, grid cell that is not wholly outside): the edges in the cell and its corner's parity."""
    return _zone_cover(shaped_rings(zones), True)


def spatial_join_within(points: DataFrame, zones: DataFrame) -> DataFrame:
    """(point, zone) rows with the point strictly inside the ring.

    ``points`` carries ``lon``/``lat``; ``zones`` carries ``ring``, closed. Column names must not collide.
    A point inside two overlapping zones gives two rows. Inner cells settle their points without an edge test.
    """
    shaped = shaped_rings(zones)
    found = shaped.groupBy("_lv").agg(F.max(F.size("_edges")).alias("n")).collect()  # one row for each level
    levels = sorted(r["_lv"] for r in found) or [0]
    cover = _zone_cover(shaped, any(r.n > rings.SMALL_RING for r in found))
    return (
        _with_cells(points, levels)
        .join(cover, CELL)
        .where(rings.inside_cell())
        .drop(*CELL, "_edges", "_odd", "_size")
    )


def lights_in_zones(lights: DataFrame, zones: DataFrame) -> DataFrame:
    """Light id, status and containing zone id."""
    return spatial_join_within(
        lights.select("light_id", "status", "lon", "lat"),
        zones.select(F.col("neighborhood_id").alias("zone_id"), "ring"),
    )


def zone_light_counts(lights: DataFrame, zones: DataFrame) -> DataFrame:
    """Lights per containing zone and status, aggregated before it meets any other table."""
    return lights_in_zones(lights, zones).groupBy("zone_id", "status").agg(F.count("*").alias("n"))


def lights_outside_zones(lights: DataFrame, zones: DataFrame) -> DataFrame:
    inside = lights_in_zones(lights, zones).select("light_id")
    return lights.join(inside, "light_id", "left_anti")


# -------------------------------------------------------------------------------- radius


def _cos_lat(lat: Column) -> Column:
    return F.greatest(F.cos(F.radians(lat)), F.lit(0.01))


def as_centers(df: DataFrame, *columns) -> DataFrame:
    """Named columns plus the row's location as ``_slon``, ``_slat`` and unit vector ``_sv``."""
    lon, lat = F.col("lon"), F.col("lat")
    return df.select(*columns, lon.alias("_slon"), lat.alias("_slat"), geo.unit_vector(lon, lat).alias("_sv"))


def _lon_reach(radius: Column) -> Column:
    """Degrees of longitude a circle reaches at its poleward end, never less than in latitude; all of them at a pole."""
    r_lat = radius / 110500.0
    top = F.abs(F.col("_slat")) + r_lat
    return F.when(top >= 89.9, F.lit(180.0)).otherwise(F.least(r_lat / _cos_lat(top), F.lit(180.0)))


def _shaped(centers: DataFrame, radius_m: Column) -> DataFrame:
    """Centres with what depends on them alone: radius, reach, level, cell size and the limits of the cell tests."""
    first = centers.select(
        *[c for c in centers.columns if c != "_r"], F.inline(F.array(F.struct(radius_m.cast("double").alias("_r"), _lon_reach(radius_m.cast("double")).alias("_r_lon"))))
    ).where("_r is not null")

    def half_chord(r: Column) -> Column:
        angle = F.least(r / (2 * geo.MEAN_RADIUS_M), F.lit(math.pi / 2))
        return F.sin(angle) * F.sin(angle)

    level = _level_of(2 * F.col("_r_lon"))
    more = F.struct(
        level.alias("_lv"),
        _size(level).alias("_size"),
        F.cos(F.radians("_slat")).alias("_cos"),
        half_chord(F.col("_r") * (1 + geo.SPHERE_SLACK)).alias("_near"),
        half_chord(F.col("_r") * (1 - geo.SPHERE_SLACK)).alias("_far"),
    )
    return first.select("*", F.inline(F.array(more)))


def circle_levels(centers: DataFrame, radius_m: Column) -> tuple[list[int], bool, int]:
    """The levels that occur, whether any circle crosses the antimeridian or holds a pole, and the number of circles."""
    around = (F.abs("_slon") + F.col("_r_lon") > 180) | (F.col("_r_lon") >= 180)
    # one row for each level
    rows = _shaped(centers, radius_m).groupBy("_lv").agg(F.max(around).alias("around"), F.count("*").alias("n")).collect()
    return sorted(r["_lv"] for r in rows) or [0], any(r.around for r in rows), sum(r.n for r in rows)


def _columns_of(lon: Column, reach: Column, size: Column) -> Column:
    """Cell columns within ``reach`` degrees of a longitude, across the antimeridian too."""

    def part(low: Column, high: Column) -> Column:
        low, high = F.greatest(low, F.lit(-180.0)), F.least(high, F.lit(180.0))
        return F.when(low <= high, F.sequence(_floor(low / size), _floor(high / size))).otherwise(F.array().cast("array<bigint>"))

    around = F.concat(part(lon - reach, lon + reach), part(lon + 360 - reach, lon + 360 + reach), part(lon - 360 - reach, lon - 360 + reach))
    return F.when(reach >= 180, part(F.lit(-180.0), F.lit(180.0))).otherwise(F.array_distinct(around))


def circle_cover(centers: DataFrame, radius_m: Column, around: bool = True) -> DataFrame:
    """Grid cells touched by each centre's circle; ``_full`` marks cells wholly inside it.

    Cell tests use the sphere with a slack, so a cell near the rim is kept as not full and its points
    are tested exactly. Circles may cross the antimeridian or hold a pole; ``around=False`` if none does.
    """
    r_lat, r_lon, size = F.col("_r") / 110500.0, F.col("_r_lon"), F.col("_size")
    lat, slon = F.col("_slat"), F.col("_slon")
    bottom, top = F.greatest(lat - r_lat, F.lit(-90.0)), F.least(lat + r_lat, F.lit(90.0))
    straight = F.sequence(_floor((slon - r_lon) / size), _floor((slon + r_lon) / size))
    cells = (
        _shaped(centers, radius_m)
        .withColumn("_cx", F.explode(_columns_of(slon, r_lon, size) if around else straight))
        .withColumn("_cy", F.explode(F.sequence(_floor(bottom / size), _floor(top / size))))
    )
    x0, y0 = F.col("_cx") * size, F.col("_cy") * size
    # the centre's longitude on the cell's side of the antimeridian
    lon = slon + 360 * F.round((x0 + size / 2 - slon) / 360) if around else slon
    box = F.struct(x0.alias("_x0"), (x0 + size).alias("_x1"), y0.alias("_y0"), (y0 + size).alias("_y1"), lon.alias("_lon"))
    # ``inline`` makes columns of what the tests share: copied into each of their uses, it outgrows what the JVM compiles
    cells = cells.select("*", F.inline(F.array(box)))
    x0, x1, y0, y1, lon = (F.col(c) for c in ("_x0", "_x1", "_y0", "_y1", "_lon"))

    def half_chord(x: Column, y: Column) -> Column:
        up, across = F.sin(F.radians(y - lat) / 2), F.sin(F.radians(x - lon) / 2)
        return up * up + F.col("_cos") * F.cos(F.radians(y)) * across * across

    far_x = F.when(F.abs(lon - x0) > F.abs(lon - x1), x0).otherwise(x1)
    tests = F.struct(
        half_chord(F.least(F.greatest(lon, x0), x1), F.least(F.greatest(lat, y0), y1)).alias("_h0"),
        F.greatest(half_chord(far_x, y0), half_chord(far_x, y1)).alias("_h1"),
        # near a pole the nearest point of a cell need not be at the clamped longitude
        ((size <= NEAR_CELL_DEG) & (r_lon < 90)).alias("_plain"),
    )
    own = [*[c for c in centers.columns if c != "_r"], "_r"]
    tested = cells.select(*own, *CELL, "_near", "_far", F.inline(F.array(tests)))
    return tested.where((F.col("_h0") <= F.col("_near")) | ~F.col("_plain")).select(
        *own, *CELL, ((F.col("_h1") <= F.col("_far")) & F.col("_plain")).alias("_full")
    )


def _located(points: DataFrame, levels: list[int]) -> DataFrame:
    """Points with their unit vector and grid cells."""
    return _with_cells(points.withColumn("_v", geo.unit_vector(F.col("lon"), F.col("lat"))), levels)


def _with_distance(pairs: DataFrame, *columns: str) -> DataFrame:
    """The kept columns with the radius ``_r`` and ``distance_m`` of a (centre, point) pair.

    Pairs beyond the radius on the sphere (plus slack) leave first. ``inline`` turns the half chord and the
    distance into real columns: as plain expressions the optimizer would copy them into every use of the
    radius test, which multiplies the work per pair and outgrows what the JVM compiles.
    """
    reach = F.least((1 + geo.SPHERE_SLACK) * F.col("_r") / (2 * geo.SEMI_MAJOR_M), F.lit(math.pi / 2))
    chords = pairs.select(
        *columns, "_r", "_sv", "_v",
        F.inline_outer(F.array(F.struct(geo.half_chord_sq(F.col("_sv"), F.col("_v")).alias("_h")))),
    ).where(F.col("_h") <= F.sin(reach) * F.sin(reach))
    meters = geo.vector_m(F.col("_sv"), F.col("_v"), F.col("_h"))
    return chords.select(*columns, "_r", F.inline_outer(F.array(F.struct(meters.alias("distance_m")))))


def _tasks(df: DataFrame) -> int:
    return TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism


def _crowded(centers: DataFrame, points: DataFrame, circles: int) -> list[tuple] | None:
    """Cells with more than a task's part of the pairs, and into how many parts to split their circles and their points.

    Looks at the cells of most pairs, two for each task: no more cells than tasks come out. None for few circles.
    """
    if circles <= FEW_CIRCLES:
        return None
    most = 2 * _tasks(points)
    of = [df.groupBy(*CELL).agg(F.count("*").cast("double").alias(name)) for df, name in ((centers, "_circles"), (points, "_spots"))]
    both = of[0].join(of[1], CELL).withColumn("_pairs", F.col("_circles") * F.col("_spots"))
    top = both.orderBy(F.desc("_pairs"), *CELL).limit(most).collect()
    total, found = sum(r["_pairs"] for r in top), []
    for r in top:
        if (shares := int(most * r["_pairs"] / total)) > 1:
            # circles go to all parts of the points and points to all parts of the circles: the fewest rows for so many shares
            parts = min(max(round(math.sqrt(shares * r["_spots"] / r["_circles"])), 1), shares)
            found.append((*(r[c] for c in CELL), shares // parts, parts))
    return found


def _dealt(df: DataFrame, crowded: list[tuple] | None, own: str, other: str) -> DataFrame:
    """Rows with a part of their cell's circles and one of its points: one part of their ``own`` side, each of the ``other``."""
    parts = {"_cparts": F.lit(1), "_pparts": F.lit(POINT_SHARES if crowded is None else 1)}
    found = df
    if crowded:
        counted = df.sparkSession.createDataFrame(crowded, "_lv int, _cx bigint, _cy bigint, _cparts int, _pparts int")
        found = df.join(F.broadcast(counted), CELL, "left")
        parts = {c: F.coalesce(c, F.lit(1)) for c in parts}
    mine = F.pmod(F.xxhash64(*df.columns), parts[own]).cast("int")
    return found.select(*df.columns, mine.alias(own), F.explode(F.sequence(F.lit(0), parts[other] - 1)).alias(other))


def _meet(centers: DataFrame, points: DataFrame, crowded: list[tuple] | None, work, schema: StructType) -> DataFrame:
    """``work(circles, spots)`` over the centres and points that share a cell, as Arrow batches of ``schema``.

    ``centers`` and ``points`` carry the cell, ``_slon`` and ``_slat`` or ``lon`` and ``lat``; ``circles`` and ``spots`` are
    record batches of their other columns and the unit vector, ``_sv`` or ``_v``. Rows are dealt by cell; the pairs of a
    cell in ``crowded`` go to several tasks. A task has the circles of one cell at a time, and the points in batches.
    """
    deal = [*CELL, "_cparts", "_pparts"]

    def side(df, number, name, own, other):
        columns = [c for c in df.columns if c not in CELL]
        return _dealt(df, crowded, own, other).select(*deal, F.lit(number).alias("_side"), F.struct(*columns).alias(name))

    left = side(centers, 0, "_c", "_cparts", "_pparts")
    right = side(points.where("_cx is not null and _cy is not null"), 1, "_p", "_pparts", "_cparts")
    rows = left.unionByName(right, allowMissingColumns=True).repartition(_tasks(points), *deal).sortWithinPartitions(*deal, "_side")
    # a unit vector is twice as long as the place it comes from: it is worked out behind the shuffle
    rows = rows.withColumns({
        "_c": F.col("_c").withField("_sv", geo.unit_vector(F.col("_c._slon"), F.col("_c._slat"))),
        "_p": F.col("_p").withField("_v", geo.unit_vector(F.col("_p.lon"), F.col("_p.lat"))),
    })

    def run(batches):
        import numpy as np

        cell, held, circles = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*deal, "_side")], axis=1)
            cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            for at, end in zip([0, *cuts], [*cuts, len(keys)]):
                if tuple(keys[at, :-1]) != cell:
                    cell, held, circles = tuple(keys[at, :-1]), [], None
                if keys[at, -1] == 0:
                    held.append(pa.RecordBatch.from_struct_array(batch.column("_c").slice(at, end - at)))
                elif held:
                    if circles is None:
                        circles = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    yield from work(circles, pa.RecordBatch.from_struct_array(batch.column("_p").slice(at, end - at)))

    return rows.mapInArrow(run, schema)


def _measure():
    """Plain functions for vectorised distances: unit vectors of a batch, and ``near(circles, spots)``.

    ``near`` gives the positions of circle and point and the distance of the pairs within the radius, in parts. With
    ``count`` pairs that the sphere settles keep no distance. They are sent by value: executors need no copy of this package.
    """
    semi_major, flat, slack, block = geo.SEMI_MAJOR_M, geo.FLATTENING, geo.SPHERE_SLACK, PAIR_BLOCK

    def vectors(batch, name):
        v = batch.column(name)
        return [v.field(i).to_numpy(zero_copy_only=False) for i in range(4)]

    def near(circles, spots, count=False):
        import numpy as np

        def limit(share):
            reach = np.sin(np.minimum(share * r / (2 * semi_major), np.pi / 2))
            return reach * reach

        def meters(i, j, h):
            # ``geo.vector_m`` on the two points' vectors
            h = np.minimum(np.maximum(h, 1e-30), 1 - 1e-12)
            a, b, c, d = sz[i], pz[j], sc[i], pc[j]
            cos_sum, sin2_q = c * d - a * b, ((a - b) ** 2 + (c - d) ** 2) / 4
            north = (1 - cos_sum) / 2 * (1 - sin2_q) / (1 - h)
            across = (1 + cos_sum) / 2 * sin2_q / h
            angle, sine = 2 * np.arcsin(np.sqrt(h)), 2 * np.sqrt(h * (1 - h))
            return semi_major * (angle * (1 - flat / 2 * (north + across)) + flat / 2 * sine * (north - across))

        r = circles.column("_r").to_numpy(zero_copy_only=False)
        (sx, sy, sz, sc), (px, py, pz, pc) = vectors(circles, "_sv"), vectors(spots, "_v")
        outer, sure, width = limit(1 + slack), limit(1 - slack), max(1, block // max(1, len(px)))
        for at in range(0, len(r), width):
            part = slice(at, at + width)
            h = sx[part, None] - px
            h *= h
            for u, v in ((sy, py), (sz, pz)):
                d = u[part, None] - v
                d *= d
                h += d
            h *= 0.25
            if count:
                inside = h <= sure[part, None]
                i, j = np.nonzero((h <= outer[part, None]) & ~inside)
                within = meters(i + at, j, h[i, j]) <= r[i + at]
                inside[i[within], j[within]] = True
                yield at, inside
            else:
                i, j = np.nonzero(h <= outer[part, None])
                m = meters(i + at, j, h[i, j])
                within = m <= r[i + at]
                yield i[within] + at, j[within], m[within]

    return near


def spatial_join_dwithin(
    centers: DataFrame, points: DataFrame, radius_m: Column, keep: list[str] | None = None
) -> DataFrame:
    """(centre, point, distance_m) rows within each centre's own radius, with the columns of both sides or those in ``keep``.

    ``centers`` comes from ``as_centers``. Points in no circle's cells leave first; the pairs of a cell are measured in blocks
    of bounded size.
    """
    left = [c for c in centers.columns if c not in ("_slon", "_slat", "_sv", "_r") and (keep is None or c in keep)]
    right = [c for c in points.columns if c not in ("_v", "_r") and (keep is None or c in keep)]
    levels, around, n = circle_levels(centers, radius_m)
    cover = circle_cover(centers.repartition(_tasks(centers)), radius_m, around).select(*left, "_slon", "_slat", "_r", *CELL)
    place = [c for c in ("lon", "lat") if c not in right]
    located = _with_cells(points, levels)
    spots = located.join(cover.select(*CELL).distinct(), CELL, "left_semi").select(*right, *place, *CELL)
    near, few = _measure(), SPOT_BLOCK

    def work(circles, found):
        for spots in (found.slice(at, few) for at in range(0, found.num_rows, few)):
            for i, j, m in near(circles, spots):
                if len(i):
                    i, j = pa.array(i), pa.array(j)
                    columns = [circles.column(c).take(i) for c in left] + [spots.column(c).take(j) for c in right]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(m)], names=[*left, *right, "distance_m"])

    schema = StructType([*[cover.schema[c] for c in left], *[spots.schema[c] for c in right], StructField("distance_m", DoubleType())])
    return _meet(cover, spots, _crowded(cover, located, n), work, schema)


def coverage_counts(suppliers: DataFrame, lights: DataFrame) -> DataFrame:
    """Lights per supplier and status within the supplier's radius.

    Cells wholly inside a circle contribute their pre-aggregated counts; only rim cells' lights are measured, and they are
    counted where they are measured. The supplier-light pairs are never written out.
    """
    centers = as_centers(suppliers, "supplier_id", "service_radius_km")
    radius = F.col("service_radius_km") * 1000
    levels, around, n = circle_levels(centers, radius)
    cover = circle_cover(centers.repartition(_tasks(centers)), radius, around)
    points = _with_cells(lights.select("light_id", "status", "lon", "lat"), levels)
    counts = points.groupBy(*CELL, "status").agg(F.count("*").alias("n"))
    inner = cover.where("_full").select("supplier_id", *CELL).join(counts, CELL).select("supplier_id", "status", "n")
    near = _measure()

    def work(circles, found):
        import numpy as np

        status = found.column("status").dictionary_encode(null_encoding="encode")
        code = status.indices.to_numpy(zero_copy_only=False)
        kinds = len(status.dictionary)
        of_kind = [code == k for k in range(kinds)]
        total = np.zeros((circles.num_rows, kinds), np.int64)
        for at, inside in near(circles, found, True):
            for k in range(kinds):
                total[at : at + len(inside), k] = np.count_nonzero(inside[:, of_kind[k]], axis=1)
        i, k = np.nonzero(total)
        if len(i):
            columns = [circles.column("supplier_id").take(pa.array(i)), status.dictionary.take(pa.array(k)), pa.array(total[i, k])]
            yield pa.RecordBatch.from_arrays(columns, names=["supplier_id", "status", "n"])

    edge = cover.where(~F.col("_full")).select("supplier_id", "_slon", "_slat", "_r", *CELL)
    rim = _meet(edge, points, _crowded(edge, points, n), work, inner.schema)
    return inner.unionByName(rim).groupBy("supplier_id", "status").agg(F.sum("n").alias("n"))


def uncovered_lights(lights: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Lights outside every supplier's own radius.

    Lights in a cell wholly inside some circle leave without a pair being formed.
    """
    centers = as_centers(suppliers, "supplier_id", "service_radius_km")
    radius = F.col("service_radius_km") * 1000
    levels, around, _ = circle_levels(centers, radius)
    cover = circle_cover(centers, radius, around)
    spots = _located(lights.select("light_id", "lon", "lat"), levels).drop("lon", "lat")
    full = cover.where("_full").select(*CELL).distinct()
    easy = spots.join(full, CELL, "left_semi").select("light_id")
    rim = spots.join(full, CELL, "left_anti").join(cover.where(~F.col("_full")), CELL)
    near = _with_distance(rim, "light_id").where(F.col("distance_m") <= F.col("_r")).select("light_id").distinct()
    return lights.join(easy.unionByName(near), "light_id", "left_anti")


def near_point(points: DataFrame, lon: float, lat: float, radius_m: float) -> DataFrame:
    """Points within a radius of one constant location, with ``distance_m``.

    The bounding box goes first: plain range predicates on the stored columns reach the file statistics.
    """
    d_lat = radius_m / 110500.0
    box = F.col("lat").between(lat - d_lat, lat + d_lat)
    if abs(lat) + d_lat < 89.9:  # else the circle holds a pole and every longitude counts
        d_lon = d_lat / max(math.cos(math.radians(abs(lat) + d_lat)), 0.001)
        if d_lon < 180:
            across = F.col("lon").between(lon - d_lon, lon + d_lon)
            if lon - d_lon < -180:
                across = across | (F.col("lon") >= lon - d_lon + 360)
            if lon + d_lon > 180:
                across = across | (F.col("lon") <= lon + d_lon - 360)
            box = box & across
    return (
        points.where(box)
        .withColumn("distance_m", geo.lambert_m(F.col("lon"), F.col("lat"), F.lit(lon), F.lit(lat)))
        .where(F.col("distance_m") <= radius_m)
    )


# -------------------------------------------------------------------------------- k nearest


class _Grid:
    """Square blocks over the right side's bounding box; level n splits the root 2^n x 2^n ways."""

    def __init__(self, x0: float, y0: float, size: float, metric: str):
        self.x0, self.y0, self.size, self.metric = x0, y0, size, metric

    def block(self, lon: Column, lat: Column, level: int) -> tuple[Column, Column]:
        s = self.size / 2**level
        return _floor((lon - self.x0) / s), _floor((lat - self.y0) / s)

    def center(self, bx: Column, by: Column, level: int) -> Column:
        """The centre of a block, ready for ``distance``."""
        s = self.size / 2**level
        return self.point((bx + 0.5) * s + self.x0, (by + 0.5) * s + self.y0)

    def point(self, lon: Column, lat: Column) -> Column:
        return F.struct(lon.alias("lon"), lat.alias("lat")) if self.metric == "planar" else geo.unit_vector(lon, lat)

    def reach(self, level: int) -> float:
        """Largest distance from a block's centre to a point in it."""
        half_diagonal = self.size / 2**level * math.sqrt(0.5) * (1 + _BOUND_SLACK) + _BOUND_SLACK
        return half_diagonal if self.metric == "planar" else half_diagonal * geo.MAX_M_PER_DEGREE

    def distance(self, p: Column, q: Column) -> Column:
        if self.metric == "planar":
            return F.sqrt(geo.planar_sq(p["lon"], p["lat"], q["lon"], q["lat"]))
        return geo.vector_sphere_m(p, q)

    def exact(self, p: Column, q: Column) -> Column:
        """The ordering measure: squared degrees or ellipsoidal metres."""
        return geo.planar_sq(p["lon"], p["lat"], q["lon"], q["lat"]) if self.metric == "planar" else geo.vector_m(p, q)

    def with_bounds(self, pairs: DataFrame, reach: float) -> DataFrame:
        """``lo`` and ``hi`` of the true distance from that of the two centres ``_p`` and ``_q``."""
        slack = 0.0 if self.metric == "planar" else geo.SPHERE_SLACK
        d = self.distance(F.col("_p"), F.col("_q"))
        return pairs.withColumn("lo", d * (1 - slack) - reach).withColumn("hi", d * (1 + slack) + reach)


def _prune(pairs: DataFrame, k: int, tag: str) -> DataFrame:
    """Keep the (block, candidate) rows that can still hold one of the block's k nearest.

    ``hi`` bounds the distance to every right row of a candidate from above, ``lo`` from below. Candidates
    are dealt into k classes by a hash of ``tag``; the largest of the classes' smallest ``hi`` is a distance
    within which k different right rows exist. A block with an empty class keeps all its candidates.
    """
    block = Window.partitionBy("bx", "by")
    deal = F.pmod(F.xxhash64(tag), F.lit(k))
    limits = [F.min(F.when(deal == i, F.col("hi")) if k > 1 else F.col("hi")).over(block).alias(f"h{i}") for i in range(k)]
    marked = pairs.select("*", *limits)
    missing = F.col("h0").isNull()
    for i in range(1, k):
        missing = missing | F.col(f"h{i}").isNull()
    limit = F.greatest(*[F.col(f"h{i}") for i in range(k)]) if k > 1 else F.col("h0")
    return marked.where(missing | (F.col("lo") <= limit)).drop("lo", "hi", *[f"h{i}" for i in range(k)])


def knn_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    k: int = 1,
    metric: str = "planar",
) -> DataFrame:
    """For every left row its k nearest right rows; adds ``nn_rank``.

    Both sides carry ``lon``/``lat`` (the right side's come back as ``r_lon``/``r_lat``); all other column
    names must differ. ``metric`` orders by degrees (``planar``) or ellipsoidal metres (``geodesic``).
    Ties go to the smaller ``right_key``. Left rows without a location have no neighbours.

    A right side of KNN_SMALL rows at most goes to the left side's tasks. Else left rows are grouped into blocks; blocks and right-hand cells are narrowed together by distance
    bounds, all by equality on cells, so the exact distance is computed for a handful of candidates per
    left row. Two small aggregates over the right side decide the number of levels: its extent, and how
    deep cells must be split until rows share them with few others. So clusters of any density and rows far
    away from the rest cost levels, not pairs.
    """
    placed = right.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    size = placed.agg(
        F.count("*").alias("n"),
        F.min("lon").alias("x0"),
        F.min("lat").alias("y0"),
        F.max("lon").alias("x1"),
        F.max("lat").alias("y1"),
    ).first()
    points = placed.withColumnRenamed("lon", "r_lon").withColumnRenamed("lat", "r_lat")
    n = size["n"]
    if n == 0:
        return left.limit(0).join(points.limit(0), F.lit(False)).withColumn("nn_rank", F.lit(1))
    extent = max(size["x1"] - size["x0"], size["y1"] - size["y0"], 1e-6) * (1 + 1e-6)
    if n <= KNN_SMALL:
        return _knn_of_few(left, points, right_key, k, metric)
    grid = _Grid(size["x0"], size["y0"], extent, metric)
    right_level = _depth(grid, points, n)
    left_level = right_level + KNN_FINER

    bx, by = grid.block(F.col("lon"), F.col("lat"), left_level)
    blocks = (
        left.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(bx.alias("bx"), by.alias("by")).distinct()
    )
    slim = points.select("r_lon", "r_lat", F.col(right_key), grid.point(F.col("r_lon"), F.col("r_lat")).alias("_q"))
    candidates = _candidates(grid, blocks, slim, left_level, right_level, right_key, k)

    best = Window.partitionBy(left_key).orderBy("_d", right_key)
    return (
        left.withColumn("bx", bx)
        .withColumn("by", by)
        .withColumn("_p", grid.point(F.col("lon"), F.col("lat")))
        .join(candidates.join(points, right_key), ["bx", "by"])
        .withColumn("_d", grid.exact(F.col("_p"), F.col("_q")))
        .withColumn("nn_rank", F.row_number().over(best))
        .where(F.col("nn_rank") <= k)
        .drop("bx", "by", "_d", "_p", "_q")
    )


def _nearest_few(x: list[float], y: list[float], k: int, metric: str):
    """An Arrow function from locations to the positions of their k nearest of a few, with all that come close to the k-th."""

    # the function is sent by value: executors need no copy of this package
    flat, share = 1 - geo.FLATTENING, geo.SPHERE_SLACK

    def run(lon: pa.Array, lat: pa.Array) -> pa.Array:
        import numpy as np

        def placed(a, b):
            if metric == "planar":
                return np.stack([a, b], axis=1)
            beta, lam = np.arctan(flat * np.tan(np.radians(b))), np.radians(a)
            return np.stack([np.cos(beta) * np.cos(lam), np.cos(beta) * np.sin(lam), np.sin(beta)], axis=1)

        right = placed(np.array(x), np.array(y))
        own = placed(*(c.to_numpy(zero_copy_only=False).astype(float) for c in (lon, lat)))
        # the sphere's chord differs from the ellipsoid's distance by a share of SPHERE_SLACK, squared here
        slack = 1e-9 if metric == "planar" else 5 * share
        rows, columns, at = [], [], 0
        while at < len(own):
            part = own[at : at + max(1, (1 << 20) // len(right))]
            d = sum((part[:, i, None] - right[None, :, i]) ** 2 for i in range(right.shape[1]))
            limit = np.partition(d, min(k, len(right)) - 1, axis=1)[:, min(k, len(right)) - 1]
            r, c = np.nonzero(d <= limit[:, None] * (1 + slack) + 1e-18)
            rows.append(r + at)
            columns.append(c)
            at += len(part)
        counts = np.bincount(np.concatenate(rows) if rows else np.zeros(0, int), minlength=len(own))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        values = np.concatenate(columns) if columns else np.zeros(0, int)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    return F.arrow_udf(run, "array<int>")


def _knn_of_few(left: DataFrame, points: DataFrame, right_key: str, k: int, metric: str) -> DataFrame:
    """``knn_join`` with KNN_SMALL right rows at most: no row of the left side is shuffled.

    Vectorised distances choose candidates with room for rounding; the exact measure decides between them in the row.
    """
    places = points.select(right_key, "r_lon", "r_lat").orderBy(right_key, "r_lon", "r_lat")
    rows = places.collect()
    choose = _nearest_few([r.r_lon for r in rows], [r.r_lat for r in rows], k, metric)
    grid = _Grid(0.0, 0.0, 1.0, metric)
    spot = F.struct(F.col(right_key).alias("key"), F.col("r_lon").alias("lon"), F.col("r_lat").alias("lat"))
    few = points.agg(F.transform(F.array_sort(F.collect_list(spot)), lambda p: F.struct(p["key"].alias("key"), grid.point(p["lon"], p["lat"]).alias("q"))))
    located = left.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    near = located.select("*", choose("lon", "lat").alias("_near"), grid.point(F.col("lon"), F.col("lat")).alias("_p"), few.scalar().alias("_few"))
    measured = F.transform(
        F.transform("_near", lambda i: F.get("_few", i)), lambda s: F.struct(grid.exact(F.col("_p"), s["q"]).alias("d"), s["key"].alias("key"))
    )
    best = F.slice(F.array_sort(measured), 1, k)
    ranked = near.select(*left.columns, F.posexplode(best).alias("_at", "_best")).select(
        *left.columns, (F.col("_at") + 1).alias("nn_rank"), F.col("_best.key").alias(right_key)
    )
    joined = ranked.join(F.broadcast(points), right_key)
    return joined.select(*left.columns, *points.columns, "nn_rank")


def _depth(grid: _Grid, points: DataFrame, n: int) -> int:
    """The level at which a row shares its cell with KNN_ROWS_PER_LEAF rows on average.

    Rows with equal locations share a cell at any level: no deeper than where most of what can part has parted.
    """
    if n <= KNN_ROWS_PER_LEAF:
        return 1
    x, y = grid.block(F.col("r_lon"), F.col("r_lat"), KNN_DEEPEST)
    fine = points.groupBy(x.alias("x"), y.alias("y")).agg(F.count("*").alias("c"))
    steps = [(level, KNN_DEEPEST - level) for level in range(1, KNN_DEEPEST + 1)]
    every = F.array(*[F.struct(F.lit(v).alias("lv"), F.shiftright("x", d).alias("cx"), F.shiftright("y", d).alias("cy")) for v, d in steps])
    cells = fine.select("c", F.inline(every)).groupBy("lv", "cx", "cy").agg(F.sum("c").alias("c"))
    shared = cells.groupBy("lv").agg((F.sum(F.col("c").cast("double") * F.col("c")) / n).alias("w"))
    by_level = {r.lv: r.w for r in shared.collect()}  # one row for each level
    return min(v for v, w in by_level.items() if w <= max(KNN_ROWS_PER_LEAF, 1.25 * by_level[KNN_DEEPEST]))


def _candidates(
    grid: _Grid, blocks: DataFrame, slim: DataFrame, left_level: int, right_level: int, right_key: str, k: int
) -> DataFrame:
    """(left block, right row, its point) that can be among the k nearest of a row in the block.

    Descends the right side's grid two levels at a time and drops cells that cannot matter. The blocks stay
    partitioned by (bx, by) throughout while the right side's cells are small enough to be broadcast;
    beyond that the joins shuffle on the cell.
    """
    located = slim.withColumns(dict(zip(("rx", "ry"), grid.block(F.col("r_lon"), F.col("r_lat"), right_level))))

    def cells_at(level: int, step: int) -> DataFrame:
        shift = right_level - level
        cells = located.select(F.shiftright("rx", shift).alias("rx"), F.shiftright("ry", shift).alias("ry")).distinct()
        return cells.select("rx", "ry", F.shiftright("rx", step).alias("px"), F.shiftright("ry", step).alias("py"))

    def bounded(pairs: DataFrame, other: Column, reach: float, *columns: str) -> DataFrame:
        placed = pairs.select("bx", "by", *columns, grid.center(F.col("bx"), F.col("by"), left_level).alias("_p"), other.alias("_q"))
        return grid.with_bounds(placed, grid.reach(left_level) + reach).drop("_p")

    # the right side's root is one cell: every block starts with its occupied children, at most 4 or 16
    levels = sorted({right_level - step for step in range(0, right_level, 2)})
    root = F.sequence(F.lit(0).cast("bigint"), F.lit(2 ** levels[0] - 1).cast("bigint"))
    pairs = blocks.withColumn("rx", F.explode(root)).withColumn("ry", F.explode(root)).join(
        cells_at(levels[0], 0).select("rx", "ry"), ["rx", "ry"]
    )
    for position, level in enumerate(levels):
        if position:
            step = level - levels[position - 1]
            pairs = pairs.select("bx", "by", F.col("rx").alias("px"), F.col("ry").alias("py")).join(cells_at(level, step), ["px", "py"])
        center = grid.center(F.col("rx"), F.col("ry"), level)
        pairs = _prune(bounded(pairs, center, grid.reach(level), "rx", "ry"), k, "_q").select("bx", "by", "rx", "ry")
    rows = pairs.join(located.drop("r_lon", "r_lat"), ["rx", "ry"])
    return _prune(bounded(rows, F.col("_q"), 0.0, right_key), k, right_key)


def nearest_supplier(
    lights: DataFrame, suppliers: DataFrame, *, metric: str = "planar", k: int = 1
) -> DataFrame:
    """Lights with their k nearest suppliers; adds supplier columns and ``distance_m`` (ellipsoidal)."""
    right = suppliers.select(
        "supplier_id",
        F.col("name").alias("supplier_name"),
        "specialization",
        "contact_phone",
        "service_radius_km",
        "avg_response_hours",
        "lon",
        "lat",
    )
    joined = knn_join(lights, right, "light_id", "supplier_id", k=k, metric=metric)
    return joined.withColumn("distance_m", geo.lambert_m(F.col("lon"), F.col("lat"), F.col("r_lon"), F.col("r_lat")))
