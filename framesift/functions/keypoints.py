"""Column expressions on keypoints: points are array<struct<x, y>>, relative or in pixels; a hidden point is NaN. No UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framesift.functions.columns import box_valid, finite

# The markup of a skeleton's nodes and edges, and the grid on which nodes lie without a template.
NODE = '<circle r="0.75" cx="%d" cy="%d" data-type="element node" data-element-id="%d" data-node-id="%d" data-label-name="%s"/>'
EDGE = '<line x1="0" y1="0" x2="1" y2="1" data-type="edge" data-node-from="%d" data-node-to="%d"/>'
GRID_LEFT, GRID_TOP, GRID_COLUMNS, GRID_STEP_X, GRID_STEP_Y = 8, 8, 7, 12, 14


def hidden(p: Column) -> Column:
    return p.isNull() | p["x"].isNull() | p["y"].isNull() | F.isnan(p["x"]) | F.isnan(p["y"])


def points_usable(points: Column, count: int) -> Column:
    """Whether there are count points; hidden ones may be NaN, none is infinite."""
    return F.coalesce((F.size(points) == count) & F.forall(points, lambda p: hidden(p) | (finite(p["x"]) & finite(p["y"]))), F.lit(False))


def absolute_points(points: Column, width: Column, height: Column) -> Column:
    """array<struct<x, y, outside>> in whole pixels, half to even; hidden points are outside, at 0, 0."""
    at = lambda v, size, out: F.when(out, 0).otherwise(F.rint(v * size)).cast("int")
    return F.transform(points, lambda p: F.struct(at(p["x"], width, hidden(p)).alias("x"), at(p["y"], height, hidden(p)).alias("y"), hidden(p).alias("outside")))


def relative_points(shapes: Column, width: Column, height: Column) -> Column:
    """array<struct<x, y, outside, occluded>> in pixels to array<struct<x, y, v>>: v 0 and NaN outside, 1 occluded, 2 visible."""
    nan = F.lit(float("nan"))

    def one(s: Column) -> Column:
        out = F.coalesce(s["outside"], F.lit(False)) | s["x"].isNull() | s["y"].isNull()
        v = F.when(out, 0).when(F.coalesce(s["occluded"], F.lit(False)), 1).otherwise(2)
        return F.struct(F.when(out, nan).otherwise(F.bround(s["x"] / width, 6)).alias("x"), F.when(out, nan).otherwise(F.bround(s["y"] / height, 6)).alias("y"), v.alias("v"))

    return F.transform(shapes, one)


def stored_visibility(value: Column, count: int) -> Column:
    """A file's visibility flag as stored: of 42 points 0 is 0 and others 2; of 68 points 0 is 2, 1 to 4 are 1, none is 0."""
    if count == 42:
        return F.when(F.coalesce(value, F.lit(0)) == 0, 0).otherwise(2)
    return F.when(value.isNull(), 0).when(value == 0, 2).when(value.between(1, 4), 1).otherwise(0)


def _all_near(a: Column, b: Column, near) -> Column:
    pair = lambda p, q: (hidden(p) & hidden(q)) | (~hidden(p) & ~hidden(q) & near(p, q))
    return F.coalesce((F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, pair), lambda v: F.coalesce(v, F.lit(False))), F.lit(False))


def points_equal(a: Column, b: Column, tol: float = 1e-5) -> Column:
    """Whether all points are equal within tol; two hidden points are equal."""
    return _all_near(a, b, lambda p, q: (F.abs(p["x"] - q["x"]) <= tol) & (F.abs(p["y"] - q["y"]) <= tol))


def points_moved(a: Column, b: Column, width: Column, height: Column, tol: float = 5.0) -> Column:
    """Whether any point moved by over tol pixels on an axis, was hidden or came up."""
    return ~_all_near(a, b, lambda p, q: (F.abs(p["x"] - q["x"]) * width <= tol) & (F.abs(p["y"] - q["y"]) * height <= tol))


def box_moved(a: Column, b: Column, width: Column, height: Column, tol: float = 5.0) -> Column:
    """Whether an edge of a relative box moved by over tol pixels."""
    edge = lambda v, k: F.get(v, F.lit(k))
    far = lambda v, k: F.get(v, F.lit(k)) + F.get(v, F.lit(k + 2))
    return F.greatest(*[F.abs(f(a, k) - f(b, k)) * s for k, s in ((0, width), (1, height)) for f in (edge, far)]) > tol


def coordinates_fit(box: Column, points: Column, width: Column, height: Column, slack: float = 1.0) -> Column:
    """Whether a box (x, y, w, h) and visible points in pixels lie in the image, with slack pixels to spare."""
    x, y, w, h = (F.get(box, F.lit(k)) for k in range(4))
    inside = (F.least(x, y) >= -slack) & (x + w <= width + slack) & (y + h <= height + slack)
    within = lambda v, size: v.between(F.lit(-slack), size + slack)
    return F.coalesce(inside & F.forall(points, lambda p: hidden(p) | (within(p["x"], width) & within(p["y"], height))), F.lit(False))


def size_outcome(box: Column, points: Column, stated: tuple[Column, Column], actual: tuple[Column, Column]) -> Column:
    """same, rescaled (the stated size differs, but all lies in the actual image) or size_mismatch."""
    same = (stated[0] == actual[0]) & (stated[1] == actual[1])
    return F.when(same, "same").when(coordinates_fit(box, points, *actual), "rescaled").otherwise("size_mismatch")


def face_box(face: Column, extent: Column) -> Column:
    """The face box where it is valid, else the box of the extent, else null."""
    return F.when(box_valid(face), face).when(box_valid(extent), extent)


def grid_positions(names: Column) -> Column:
    """A place for each node of a skeleton without a template, as array<struct<x, y>>."""
    return F.transform(names, lambda _, i: F.struct((F.lit(GRID_LEFT) + (i % GRID_COLUMNS) * GRID_STEP_X).alias("x"), (F.lit(GRID_TOP) + F.floor(i / GRID_COLUMNS) * GRID_STEP_Y).alias("y")))


def skeleton_markup(names: Column, edges: Column, positions: Column | None = None) -> Column:
    """The inner markup of a skeleton drawing: nodes in order of names, then edges (array<array<int>>; shorter ones go)."""
    def escaped(n: Column) -> Column:
        for raw, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
            n = F.replace(n, F.lit(raw), F.lit(code))
        return n

    nodes = F.zip_with(F.transform(names, escaped), grid_positions(names) if positions is None else positions, lambda n, p: F.struct(n.alias("n"), p.alias("p")))
    circles = F.transform(nodes, lambda v, i: F.format_string(NODE, v["p"]["x"].cast("int"), v["p"]["y"].cast("int"), i, i, v["n"]))
    lines = F.transform(F.filter(edges, lambda e: F.size(e) >= 2), lambda e: F.format_string(EDGE, e[0], e[1]))
    return F.concat(F.array_join(circles, ""), F.array_join(lines, ""))


def upload_shapes(pairs: Column, width: Column, height: Column, frame: Column, box_label: int, skeleton_label: int, node_labels: list[int]) -> Column:
    """pairs array<struct<box, points array<struct<x, y, v>>>> as shapes for an annotation server: for each pair a
    rectangle and a skeleton of one group, numbered from 1. Nodes that are hidden or have v = 0 are outside; v = 1 occluded."""
    none = F.array().cast("array<string>")
    fixed = lambda group: [frame.alias("frame"), group.alias("group"), F.lit("manual").alias("source"), F.lit(0).alias("z_order"), F.lit(0).alias("rotation"), none.alias("attributes")]
    ids = F.array(*[F.lit(n) for n in node_labels])

    def node(p: Column, i: Column, group: Column) -> Column:
        out = hidden(p) | F.coalesce(p["v"] == 0, F.lit(False))
        at = F.array(*[F.when(out, 0).otherwise(F.rint(p[k] * s)).cast("int") for k, s in (("x", width), ("y", height))])
        return F.struct(F.lit("points").alias("type"), (~out & F.coalesce(p["v"] == 1, F.lit(False))).alias("occluded"), out.alias("outside"), at.alias("points"), F.get(ids, i).alias("label_id"), *fixed(group))

    def shape(kind: str, label: int, points: Column, elements: Column, group: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.lit(False).alias("occluded"), F.lit(False).alias("outside"), points.alias("points"), F.lit(label).alias("label_id"), *fixed(group), elements.alias("elements"))

    def both(pair: Column, i: Column) -> Column:
        x, y, w, h = (pair["box"][k] for k in range(4))
        corners = F.array(*[F.rint(v * s).cast("int") for v, s in ((x, width), (y, height), (x + w, width), (y + h, height))])
        nodes = F.transform(pair["points"], lambda p, k: node(p, k, i + 1))
        nothing = F.array().cast("array<int>")
        return F.array(shape("rectangle", box_label, corners, F.filter(nodes, lambda _: F.lit(False)), i + 1), shape("skeleton", skeleton_label, nothing, nodes, i + 1))

    return F.flatten(F.transform(pairs, both))
