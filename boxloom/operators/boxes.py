"""Row-wise work on boxes: validation, clipping, geometry, normalization, regions. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORNERS = ("xmin", "ymin", "xmax", "ymax")


def _bad(c: Column) -> Column:
    return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))


def box_issues(corners=CORNERS, width="width", height="height") -> Column:
    """The issues of a box; a number that is not finite is the only issue then. Unknown sizes skip the bounds."""
    x1, y1, x2, y2 = (F.col(c) for c in corners)
    w, h = F.col(width), F.col(height)
    known = (F.coalesce(w, F.lit(0)) > 0) & (F.coalesce(h, F.lit(0)) > 0)
    issues = F.array_compact(F.array(
        F.when((x1 < 0) | (y1 < 0), "NEGATIVE_COORDINATE"),
        F.when((x2 <= x1) | (y2 <= y1), "NON_POSITIVE_SIZE"),
        F.when(known & (x2 > w), "X_OUT_OF_BOUNDS"),
        F.when(known & (y2 > h), "Y_OUT_OF_BOUNDS"),
    ))
    broken = _bad(x1) | _bad(y1) | _bad(x2) | _bad(y2)
    return F.when(broken, F.array(F.lit("NAN_OR_INFINITY"))).otherwise(issues)


def box_validate(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("issues", box_issues()).withColumn("is_valid", F.size("issues") == 0)


def box_issues_long(boxes: DataFrame) -> DataFrame:
    """One row for each box and issue."""
    return box_validate(boxes).withColumn("issue", F.explode("issues")).drop("issues", "is_valid")


def box_clip(boxes: DataFrame) -> DataFrame:
    """The box clipped to its image, which sides were clipped, and whether anything is left. Needs image sizes."""
    out = boxes.select(
        "*",
        F.greatest("xmin", F.lit(0.0)).alias("cx0"), F.greatest("ymin", F.lit(0.0)).alias("cy0"),
        F.least("xmax", F.col("width").cast("double")).alias("cx1"), F.least("ymax", F.col("height").cast("double")).alias("cy1"),
    )
    sides = F.array_compact(F.array(
        F.when(F.col("xmin") < 0, "LEFT_BOUNDARY_CLIPPED"), F.when(F.col("ymin") < 0, "TOP_BOUNDARY_CLIPPED"),
        F.when(F.col("xmax") > F.col("width"), "RIGHT_BOUNDARY_CLIPPED"), F.when(F.col("ymax") > F.col("height"), "BOTTOM_BOUNDARY_CLIPPED"),
    ))
    visible = (F.col("cx1") > F.col("cx0")) & (F.col("cy1") > F.col("cy0")) & (F.size(F.col("adjustments")) >= 0)
    out = out.withColumn("adjustments", sides)
    return out.withColumn("clip_adjustments", F.array_join("adjustments", "|")).withColumn(
        "clip_applied", F.size("adjustments") > 0
    ).withColumn("visible", visible).drop("adjustments")


def box_geometry(boxes: DataFrame) -> DataFrame:
    """Share of the image area, size category and a distance proxy from it."""
    ratio = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) / (F.col("width") * F.col("height"))
    out = boxes.withColumn("area_ratio", ratio)
    size = F.when(F.col("area_ratio") < 0.001, "SMALL").when(F.col("area_ratio") < 0.02, "MEDIUM").otherwise("LARGE")
    far = F.when(F.col("area_ratio") < 0.001, "FAR").when(F.col("area_ratio") < 0.02, "MEDIUM").otherwise("NEAR")
    return out.withColumn("size_category", size).withColumn("distance_proxy", far)


def letterbox_metrics(boxes: DataFrame, target: int = 320) -> DataFrame:
    """Size after scaling the image into a square; category by the shorter side. Unknown sizes: NOT_COMPUTED."""
    known = (F.coalesce(F.col("width"), F.lit(0)) > 0) & (F.coalesce(F.col("height"), F.lit(0)) > 0)
    scale = F.when(known, F.least(F.lit(float(target)) / F.col("width"), F.lit(float(target)) / F.col("height")))
    out = boxes.withColumn("lb_scale", scale)
    out = out.withColumn("lb_w", (F.col("xmax") - F.col("xmin")) * F.col("lb_scale"))
    out = out.withColumn("lb_h", (F.col("ymax") - F.col("ymin")) * F.col("lb_scale"))
    short = F.least("lb_w", "lb_h")
    category = (
        F.when(F.col("lb_scale").isNull(), "NOT_COMPUTED").when(short < 4, "EXTREMELY_TINY")
        .when(short < 8, "VERY_SMALL").when(short < 16, "SMALL").otherwise("USABLE")
    )
    return out.withColumn("lb_area", F.col("lb_w") * F.col("lb_h")).withColumn("lb_category", category)


def device_size_group(boxes: DataFrame, device_w: int = 640, device_h: int = 480) -> DataFrame:
    scale = F.least(F.lit(float(device_w)) / F.col("width"), F.lit(float(device_h)) / F.col("height"))
    short = F.least(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")) * scale
    return boxes.withColumn("size_group", F.when(short < 25, "<25").when(short < 50, "25–49").otherwise("≥50"))


def yolo_normalize(boxes: DataFrame, corners=("cx0", "cy0", "cx1", "cy1")) -> DataFrame:
    """Centre and size in shares of the image, and the label line; a box outside its image is an error."""
    x1, y1, x2, y2 = (F.col(c) for c in corners)
    out = boxes.select(
        "*", ((x1 + x2) / 2 / F.col("width")).alias("nx"), ((y1 + y2) / 2 / F.col("height")).alias("ny"),
        ((x2 - x1) / F.col("width")).alias("nw"), ((y2 - y1) / F.col("height")).alias("nh"),
    )
    outside = F.greatest("nx", "ny", "nw", "nh") > 1
    outside = outside | (F.least("nx", "ny", "nw", "nh") < 0)
    line = F.format_string("0 %.8f %.8f %.8f %.8f", "nx", "ny", "nw", "nh")
    return out.withColumn("label_line", F.when(outside, F.raise_error(F.lit("box outside of its image"))).otherwise(line))


def yolo_denormalize(lines: DataFrame) -> DataFrame:
    """Label lines (``label_line``) with image sizes back to pixel corners."""
    part = F.split("label_line", " ")
    nx, ny, nw, nh = (part[k].try_cast("double") for k in range(1, 5))
    w, h = F.col("width"), F.col("height")
    return lines.select(
        "*", ((nx - nw / 2) * w).alias("px0"), ((ny - nh / 2) * h).alias("py0"), ((nx + nw / 2) * w).alias("px1"), ((ny + nh / 2) * h).alias("py1")
    )


def split_by_regions(boxes: DataFrame, regions: DataFrame, on: str = "sequence_id") -> DataFrame:
    """``ignored`` is true where the box centre lies in a region of the same sequence, border included.

    Regions are matched by equality on the sequence first; the range conditions run on those only.
    """
    b = boxes.select("*", ((F.col("xmin") + F.col("xmax")) / 2).alias("_x"), ((F.col("ymin") + F.col("ymax")) / 2).alias("_y"))
    r = regions.groupBy(on).agg(F.collect_set(F.struct("left", "top", "right", "bottom")).alias("_rs"))
    hit = F.expr("exists(coalesce(_rs, array()), r -> _x BETWEEN r.left AND r.right AND _y BETWEEN r.top AND r.bottom)")
    return b.join(r, on, "left").withColumn("ignored", hit).drop("_x", "_y", "_rs")


def point_in_polygon(x: Column, y: Column, polygon: list[tuple[float, float]], eps: float = 1e-9) -> Column:
    """Even-odd rule for a literal polygon; points on an edge are inside."""
    if len(set(polygon)) < 3:
        raise ValueError("a polygon needs three distinct points")
    inside, edge = F.lit(False), F.lit(False)
    for (x1, y1), (x2, y2) in zip(polygon, polygon[1:] + polygon[:1], strict=True):
        cross = (x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)
        within = (x >= min(x1, x2) - eps) & (x <= max(x1, x2) + eps) & (y >= min(y1, y2) - eps) & (y <= max(y1, y2) + eps)
        edge = edge | ((F.abs(cross) <= eps) & within)
        if y1 != y2:
            crosses = (F.lit(y1) > y) != (F.lit(y2) > y)
            inside = inside != (crosses & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1))
    return edge | inside


def roi_polygon(config: dict) -> list[tuple[int, int]]:
    """Pixel polygon of a calibrated region: distinct points in [0, 1], scaled by the frame size less one."""
    if config.get("status") != "CALIBRATED":
        raise ValueError("the region is not calibrated")
    points, (w, h) = config["normalized_polygon"], config["frame_size_px"]
    if len({tuple(p) for p in points}) < 3 or any(not 0 <= c <= 1 for p in points for c in p):
        raise ValueError("a region needs three distinct points in [0, 1]")
    return [(round(x * (w - 1)), round(y * (h - 1))) for x, y in points]


def homography(image_points: list, world_points: list) -> list[float]:
    """The eight coefficients that take four image points to four world points."""
    import numpy as np

    rows, right = [], []
    for (x, y), (u, v) in zip(image_points, world_points, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    return np.linalg.solve(np.array(rows, float), np.array(right, float)).tolist()


def ground_project(x: Column, y: Column, h: list[float]) -> tuple[Column, Column]:
    """Metres on the ground for an image point; a point on the horizon is an error."""
    below = x * h[6] + y * h[7] + 1.0
    below = F.when(F.abs(below) < 1e-12, F.raise_error(F.lit("point on the horizon")).cast("double")).otherwise(below)
    return (x * h[0] + y * h[1] + h[2]) / below, (x * h[3] + y * h[4] + h[5]) / below


def ground_range(gx: Column, gy: Column, camera: tuple[float, float]) -> Column:
    return F.hypot(gx - camera[0], gy - camera[1])


def foot_point() -> tuple[Column, Column]:
    return (F.col("xmin") + F.col("xmax")) / 2, F.col("ymax")


def iou(a=CORNERS, b=("xmin2", "ymin2", "xmax2", "ymax2")) -> Column:
    """Intersection over union of two boxes of a row; 0 without overlap."""
    ax, ay, au, av = (F.col(c) for c in a)
    bx, by, bu, bv = (F.col(c) for c in b)
    inter = F.greatest(F.least(au, bu) - F.greatest(ax, bx), F.lit(0.0)) * F.greatest(F.least(av, bv) - F.greatest(ay, by), F.lit(0.0))
    union = (au - ax) * (av - ay) + (bu - bx) * (bv - by) - inter
    return F.when(union > 0, inter / union).otherwise(0.0)
