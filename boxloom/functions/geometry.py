"""Box and polygon arithmetic as column expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from boxloom.constants import MEDIUM_AREA, SMALL_AREA

CORNERS = ("x1", "y1", "x2", "y2")


def c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def corners(side: str = "") -> list[Column]:
    """The four corner columns of a box; `side` is a struct or alias name such as 'a'."""
    return [F.col(f"{side}.{name}" if side else name) for name in CORNERS]


def width(box: list[Column]) -> Column:
    return box[2] - box[0]


def height(box: list[Column]) -> Column:
    return box[3] - box[1]


def area(box: list[Column]) -> Column:
    return width(box) * height(box)


def centre(box: list[Column]) -> tuple[Column, Column]:
    return (box[0] + box[2]) / F.lit(2.0), (box[1] + box[3]) / F.lit(2.0)


def aspect(box: list[Column]) -> Column:
    return F.try_divide(width(box), height(box))


def overlaps(a: list[Column], b: list[Column]) -> Column:
    """Open-interval overlap: boxes that only touch do not overlap."""
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def intersection(a: list[Column], b: list[Column]) -> Column:
    zero = F.lit(0.0)
    across = F.greatest(zero, F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    down = F.greatest(zero, F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return across * down


def iou(a: list[Column], b: list[Column]) -> Column:
    shared = intersection(a, b)
    return F.coalesce(F.try_divide(shared, area(a) + area(b) - shared), F.lit(0.0))


def overlap_ratio(a: list[Column], b: list[Column]) -> Column:
    """Share of box `a` covered by box `b`."""
    return F.coalesce(F.try_divide(intersection(a, b), area(a)), F.lit(0.0))


def finite(value: Column) -> Column:
    """False for null, NaN and both infinities: NaN passes plain range checks in Spark."""
    number = value.cast("double")
    return F.coalesce(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), F.lit(False))


def size_bucket(box_area: Column, small: float = SMALL_AREA, medium: float = MEDIUM_AREA) -> Column:
    return F.when(box_area < small, "small").when(box_area < medium, "medium").otherwise("large")


def percent_box(box: list[Column], image_width: Column, image_height: Column) -> Column:
    """Pixel corners to the percentage rectangle (x, y, width, height) of the image."""
    return F.struct(
        (box[0] * 100.0 / image_width).alias("x"),
        (box[1] * 100.0 / image_height).alias("y"),
        (width(box) * 100.0 / image_width).alias("width"),
        (height(box) * 100.0 / image_height).alias("height"),
    )


def from_percent_box(rect: Column, image_width: Column, image_height: Column) -> Column:
    left = rect["x"] * image_width / 100.0
    top = rect["y"] * image_height / 100.0
    return F.struct(
        left.alias("x1"),
        top.alias("y1"),
        (left + rect["width"] * image_width / 100.0).alias("x2"),
        (top + rect["height"] * image_height / 100.0).alias("y2"),
    )


def let(value: Column, body) -> Column:
    """Bind `value` once, so that `body` may use it many times without growing the tree."""
    return F.transform(F.array(value), body)[0]


def polygon_area(points: Column) -> Column:
    """Shoelace area of an array of (x, y) structs; 0 below three points."""
    n = F.size(points)
    following = F.concat(F.slice(points, 2, F.greatest(n - 1, F.lit(0))), F.slice(points, 1, 1))
    cross = F.zip_with(points, following, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    doubled = F.aggregate(cross, F.lit(0.0), lambda total, term: total + term)
    return F.when(n >= 3, F.abs(doubled) / 2.0).otherwise(0.0)


def polygon_edges(points: Column) -> Column:
    """Edges of a polygon as (x, y, to_x, slope); upright ones are left out, since no area lies under them."""
    following = F.concat(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))
    edges = F.zip_with(points, following, lambda p, q: F.struct(
        p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"), q["x"].cast("double").alias("to_x"),
        F.try_divide((q["y"] - p["y"]).cast("double"), q["x"] - p["x"]).alias("slope"),
    ))
    return F.filter(edges, lambda e: e["slope"].isNotNull())


def edges_box_area(edges: Column, box: list[Column]) -> Column:
    """Area shared by a simple polygon, given by its `polygon_edges`, and a box.

    Each edge adds the signed area under it that lies in the box, in closed form: nothing is clipped, so concave polygons
    need no care, and polygons of horizontal and upright edges over whole pixels are exact.
    """
    x1, y1, x2, y2 = box
    tall = F.greatest(y2 - y1, F.lit(0.0))

    def under(e: Column) -> Column:
        left, right = (F.greatest(x1, F.least(e[n], x2)) for n in ("x", "to_x"))
        low, high = (e["y"] + (x - e["x"]) * e["slope"] - y1 for x in (left, right))
        inside = lambda d: F.greatest(F.least(d, tall), F.lit(0.0))
        # the integral of the part inside the box along a rising or falling edge
        grown = lambda d: inside(d) * inside(d) / 2.0 + tall * F.greatest(d - tall, F.lit(0.0))
        flat = inside(low) * (right - left)
        return F.when(right == left, 0.0).when(low == high, flat).otherwise((grown(high) - grown(low)) / e["slope"])

    return F.abs(F.aggregate(edges, F.lit(0.0), lambda total, e: total + under(e)))


def polygon_box_area(points: Column, box: list[Column]) -> Column:
    """Area shared by a simple polygon and a box."""
    return edges_box_area(polygon_edges(points), box)
