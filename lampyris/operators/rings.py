"""Rings cut to grid cells: inner cells settle a point without an edge, rim cells carry only their own edges.

A rim cell knows the parity of its lower right corner: how many edges a ray to the right of it meets. From a point one
goes to the right until the cell's side and down along it to the corner; each edge met on the way turns the parity, and
all those edges are the cell's own. The tests use the even-odd rule of ``geo.in_edges`` with its half-open spans, as if
the side lay a hair to the right and the lower border a hair up, so vertices and edges on cell borders count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rings of up to so many edges are cut inside their own row, larger ones edge by edge.
SMALL_RING = 64
# Share of a cell by which edges are taken to reach further than they do: more edges than needed change nothing.
_PAD = 1e-6


# The tests below are SQL text: parsed at once, where columns built one by one would cost more than small joins take.


def _raw(e: str, x: str, y: str) -> str:
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"


def _left(e: str, x: str, y: str) -> str:
    """To the left of the edge; on its line as a hair to the right, or above where it is level."""
    raw = _raw(e, x, y)
    return f"(case when {raw} <> 0 then {raw} > 0 when {e}.y1 <> {e}.y2 then {e}.y1 > {e}.y2 else {e}.x2 > {e}.x1 end)"


def ray_meets(e: str, x: str, y: str) -> str:
    """The ray to the right of a point meets the edge."""
    spans = f"((({e}.y1 <= {y}) and ({e}.y2 > {y})) or (({e}.y2 <= {y}) and ({e}.y1 > {y})))"
    aside = f"(greatest({e}.x1, {e}.x2) > {x} and {_left(e, x, y)} = ({e}.y2 > {e}.y1))"
    return f"({spans} and (least({e}.x1, {e}.x2) > {x} or {aside}))"


def _above(e: str, x: str, y: str) -> str:
    """The edge passes the upright line at ``x`` below the point."""
    spans = f"((({e}.x1 <= {x}) and ({e}.x2 > {x})) or (({e}.x2 <= {x}) and ({e}.x1 > {x})))"
    near = f"(least({e}.y1, {e}.y2) <= {y} and {_left(e, x, y)} = ({e}.x2 > {e}.x1))"
    return f"({spans} and (greatest({e}.y1, {e}.y2) < {y} or {near}))"


def _touches(e: str, x: str, y: str) -> str:
    """The point lies on the edge."""
    box = f"{x} between least({e}.x1, {e}.x2) and greatest({e}.x1, {e}.x2) and {y} between least({e}.y1, {e}.y2) and greatest({e}.y1, {e}.y2)"
    return f"({_raw(e, x, y)} = 0 and {box})"


def inside_cell(lon: str = "lon", lat: str = "lat") -> Column:
    """A point of the cell (``_cx``, ``_cy``, ``_size``, ``_edges``, ``_odd``) lies strictly inside the ring."""
    x1, y0 = "((_cx + 1) * _size)", "(_cy * _size)"
    flat = f"{ray_meets('e', lon, lat)} <> {ray_meets('e', x1, lat)}"
    upright = f"{_above('e', x1, lat)} <> {_above('e', x1, y0)}"
    parity = f"(size(filter(_edges, e -> ({flat}) <> ({upright}))) + _odd) % 2 = 1"
    return F.expr(f"case when size(_edges) = 0 then _odd = 1 else {parity} and not exists(_edges, e -> {_touches('e', lon, lat)}) end")


def _columns_in(e: str, y_low: str, y_high: str) -> tuple[str, str]:
    """First and last cell column that an edge reaches between two heights (which it does reach)."""
    low, high = f"least({e}.x1, {e}.x2)", f"greatest({e}.x1, {e}.x2)"

    def at(y: str) -> str:
        # at the ends the ends themselves; between them no further than they are
        return f"least(greatest({e}.x1 + ({y} - {e}.y1) * ({e}.x2 - {e}.x1) / nullif({e}.y2 - {e}.y1, 0D), {low}), {high})"

    a, b = at(f"greatest({y_low}, least({e}.y1, {e}.y2))"), at(f"least({y_high}, greatest({e}.y1, {e}.y2))")
    first = f"(case when {e}.y1 = {e}.y2 then {low} else least({a}, {b}) end)"
    last = f"(case when {e}.y1 = {e}.y2 then {high} else greatest({a}, {b}) end)"
    return f"floor({first} / _size - {_PAD}D)", f"floor({last} / _size + {_PAD}D)"


def small_cover(zones: DataFrame) -> DataFrame:
    """Cells of rings with few edges, found inside each ring's row.

    ``zones`` has ``_edges``, ``_b`` (bounding box), ``_lv`` and ``_size``; the rows get ``_cx``, ``_cy``, ``_odd`` and the
    cell's own ``_edges``. Cells outside the ring are left out.
    """
    rest = [c for c in zones.columns if c not in ("_edges", "_b")]
    across = f"explode(sequence(floor(_b.min_lon / _size - {_PAD}D), floor(_b.max_lon / _size + {_PAD}D))) as _cx"
    up = f"explode(sequence(floor(_b.min_lat / _size - {_PAD}D), floor(_b.max_lat / _size + {_PAD}D))) as _cy"
    cells = zones.selectExpr("*", across).selectExpr("*", up)
    low, high = f"((_cy - {_PAD}D) * _size)", f"((_cy + 1 + {_PAD}D) * _size)"
    first, last = _columns_in("e", low, high)
    reaches = f"greatest(e.y1, e.y2) >= {low} and least(e.y1, e.y2) <= {high} and _cx between {first} and {last}"
    meets = ray_meets("e", "((_cx + 1) * _size)", "(_cy * _size)")
    found = f"inline(array(struct(filter(_edges, e -> {reaches}) as _edges, size(filter(_edges, e -> {meets})) % 2 as _odd)))"
    return cells.selectExpr(*rest, "_cx", "_cy", found).where("size(_edges) > 0 or _odd = 1")


def large_cover(zones: DataFrame) -> DataFrame:
    """``small_cover`` for rings of any size: edges are dealt to the cells they reach and met in rows of cells.

    Where an edge crosses the lower border of a row of cells, the parity of the corners to its left turns. So one
    running sum along the row, from the right, has the parities of its rim cells and finds the inner cells between them.
    """
    attributes = [c for c in zones.columns if c not in ("_edges", "_b", "_lv", "_size")]
    edges = zones.withColumn("_z", F.monotonically_increasing_id()).select(
        "_z", "_lv", "_size", F.struct(*attributes).alias("_a"), F.explode("_edges").alias("e")
    )
    rows = f"explode(sequence(floor(least(e.y1, e.y2) / _size - {_PAD}D), floor(greatest(e.y1, e.y2) / _size + {_PAD}D))) as _cy"
    edges = edges.selectExpr("*", rows).selectExpr("*", "_cy * _size as y0")
    first, last = _columns_in("e", f"((_cy - {_PAD}D) * _size)", f"((_cy + 1 + {_PAD}D) * _size)")
    # corners of the columns before ``turn`` have the crossing on their right; the test itself decides close ones
    about = "floor((e.x1 + (y0 - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0D)) / _size)"
    near = [f"if({ray_meets('e', f'((about + {i}) * _size)', 'y0')}, 1, 0)" for i in (0, 1)]
    crosses = "((e.y1 <= y0 and e.y2 > y0) or (e.y2 <= y0 and e.y1 > y0))"
    met = edges.selectExpr("*", f"inline(array(struct({first} as a, {last} as b, if({crosses}, {about}, null) as about)))")
    touched = "transform(sequence(a, b), c -> struct(c as _cx, 0 as turns, e as own))"
    turned = f"array(struct(about - 1 + {near[0]} + {near[1]} as _cx, 1 as turns, if(false, e, null) as own))"
    dealt = met.selectExpr("_z", "_lv", "_size", "_a", "_cy", f"inline(if(about is null, {touched}, concat({touched}, {turned})))")
    cells = dealt.groupBy("_z", "_lv", "_cy", "_cx").agg(
        F.first("_a").alias("_a"), F.first("_size").alias("_size"), F.sum("turns").alias("turns"), F.collect_list("own").alias("own")
    )
    # from the right: what turned in the columns beyond, and the next column that has anything
    order = Window.partitionBy("_z", "_lv", "_cy").orderBy(F.desc("_cx"))
    beyond = F.coalesce(F.sum("turns").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    cells = cells.select("*", beyond.cast("int").alias("_odd"), F.lag("_cx").over(order).alias("next"))
    filled = "explode(if(_odd = 1, sequence(_cx, coalesce(next - 1, _cx)), array(_cx))) as c"
    own = "if(c = _cx, own, slice(own, 1, 0)) as _edges"
    out = cells.selectExpr("*", filled).selectExpr("_a.*", "_lv", "_size", "c as _cx", "_cy", own, "_odd")
    return out.where("size(_edges) > 0 or _odd = 1")


def _cross(a: str, b: str) -> str:
    """Two edges cross in a point inside both."""

    def side(e: str, x: str, y: str) -> str:
        return f"signum({_raw(e, x, y)})"

    one = f"{side(a, f'{b}.x1', f'{b}.y1')} * {side(a, f'{b}.x2', f'{b}.y2')} < 0"
    return f"({one} and {side(b, f'{a}.x1', f'{a}.y1')} * {side(b, f'{a}.x2', f'{a}.y2')} < 0)"


def crosses_itself(edges: str) -> Column:
    """Some two edges of an array cross, every pair tested: for few edges."""
    numbered = f"transform({edges}, (e, i) -> struct(i, e))"
    return F.expr(f"exists({numbered}, p -> exists({numbered}, q -> q.i > p.i + 1 and {_cross('p.e', 'q.e')}))")


def crossing_rings(zones: DataFrame, key: str) -> DataFrame:
    """The keys of rings that cross themselves: edges are dealt to the cells they reach and tested with those they meet there.

    ``zones`` has ``_edges``, ``_lv`` and ``_size``. Where two edges cross, both reach the cell of that point.
    """
    edges = zones.select(key, "_size", F.posexplode("_edges").alias("i", "e"))
    rows = f"explode(sequence(floor(least(e.y1, e.y2) / _size - {_PAD}D), floor(greatest(e.y1, e.y2) / _size + {_PAD}D))) as _cy"
    first, last = _columns_in("e", f"((_cy - {_PAD}D) * _size)", f"((_cy + 1 + {_PAD}D) * _size)")
    dealt = edges.selectExpr("*", rows).selectExpr("*", f"explode(sequence({first}, {last})) as _cx")
    cells = dealt.groupBy(key, "_cy", "_cx").agg(F.collect_list(F.struct("i", "e")).alias("own")).where("size(own) > 1")
    met = f"exists(own, p -> exists(own, q -> q.i > p.i + 1 and {_cross('p.e', 'q.e')}))"
    return cells.where(met).select(key).distinct()
