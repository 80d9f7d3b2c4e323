"""Boxes as columns. Corner boxes are (x1, y1, x2, y2), normalised ones (xc, yc, w, h) in 0..1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def to_corners(xc: Column, yc: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    return (xc * width - w * width / 2, yc * height - h * height / 2, xc * width + w * width / 2, yc * height + h * height / 2)


def clip(box: Box, width: Column, height: Column) -> Box:
    """Into [0, width] x [0, height]."""
    zero = F.lit(0.0)
    return (F.greatest(zero, box[0]), F.greatest(zero, box[1]), F.least(width, box[2]), F.least(height, box[3]))


def clamp_to_pixels(box: Box, width: Column, height: Column) -> Box:
    """Every corner into [0, width - 1] x [0, height - 1]."""
    into = lambda v, most: F.greatest(F.lit(0.0), F.least(most - 1.0, v))
    return (into(box[0], width), into(box[1], height), into(box[2], width), into(box[3], height))


def from_corners(box: Box, width: Column, height: Column) -> Box:
    x1, y1, x2, y2 = box
    return ((x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height)


def from_top_left(x: Column, y: Column, w: Column, h: Column) -> Box:
    """Corners of a box that is given by its top left corner and size."""
    return (x, y, x + w, y + h)


def ordered(x1: Column, y1: Column, x2: Column, y2: Column) -> Box:
    return (F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2))


def degenerate(box: Box) -> Column:
    return (box[2] <= box[0]) | (box[3] <= box[1])


def in_unit(*values: Column) -> Column:
    """All are numbers in the closed unit interval; NaN is not."""
    ok = F.lit(True)
    for v in values:
        ok = ok & v.between(0, 1) & ~F.isnan(v)
    return ok


def area(box: Box) -> Column:
    return F.greatest(F.lit(0.0), box[2] - box[0]) * F.greatest(F.lit(0.0), box[3] - box[1])


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where the union has no area."""
    both = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def crossing(box: Box, width: Column, height: Column, by: float = 1e-9) -> Column:
    """Whether a box crosses the border by more than rounding does."""
    return (box[0] < -by) | (box[1] < -by) | (box[2] > width + by) | (box[3] > height + by)


def padded_crop(box: Box, pad: float, width: Column, height: Column) -> Box:
    """Whole-pixel crop with padding, cut off at the border."""
    cut = lambda v: v.cast("int")
    return (F.greatest(F.lit(0), cut(box[0] - pad)), F.greatest(F.lit(0), cut(box[1] - pad)), F.least(cut(width), cut(box[2] + pad)), F.least(cut(height), cut(box[3] + pad)))


# Test-time views of an image, and the factors of the two scaled ones.
VIEWS = ("original", "flip_h", "flip_v", "rotate_90", "rotate_180", "rotate_270", "scale_up", "scale_down")
SCALE_UP, SCALE_DOWN = 1.25, 0.833


def view_forward(view: Column, box: Box, width: Column, height: Column) -> Column:
    """A box as the view of the image shows it: struct x1, y1, x2, y2."""
    x1, y1, x2, y2 = box
    return _by_view(view, {
        "flip_h": (width - x2, y1, width - x1, y2), "flip_v": (x1, height - y2, x2, height - y1), "rotate_180": (width - x2, height - y2, width - x1, height - y1),
        "rotate_90": (height - y2, x1, height - y1, x2), "rotate_270": (y1, width - x2, y2, width - x1),
        "scale_up": tuple(v * SCALE_UP for v in box), "scale_down": tuple(v * SCALE_DOWN for v in box),
    }, box)


def view_inverse(view: Column, box: Box, width: Column, height: Column) -> Column:
    """A box of a view, in the image: the inverse of view_forward."""
    x1, y1, x2, y2 = box
    return _by_view(view, {
        "flip_h": (width - x2, y1, width - x1, y2), "flip_v": (x1, height - y2, x2, height - y1), "rotate_180": (width - x2, height - y2, width - x1, height - y1),
        "rotate_90": (y1, height - x2, y2, height - x1), "rotate_270": (width - y2, x1, width - y1, x2),
        "scale_up": tuple(v / SCALE_UP for v in box), "scale_down": tuple(v / SCALE_DOWN for v in box),
    }, box)


def _by_view(view: Column, boxes: dict[str, Box], other: Box) -> Column:
    pack = lambda b: F.struct(*[v.alias(n) for v, n in zip(b, ("x1", "y1", "x2", "y2"), strict=True)])
    out = None
    for name, b in boxes.items():
        out = F.when(view == name, pack(b)) if out is None else out.when(view == name, pack(b))
    return out.otherwise(pack(other))


def clip_unit(xc: Column, yc: Column, w: Column, h: Column, least: float = 1e-6) -> Box:
    """A normalised box with its centre in the unit square and sizes of least to 1."""
    into = lambda v, low: F.greatest(F.lit(low), F.least(F.lit(1.0), v))
    return (into(xc, 0.0), into(yc, 0.0), into(w, least), into(h, least))


def affine(box: Box, scale: float, dx: float, dy: float) -> Box:
    return tuple(v * scale + d for v, d in zip(box, (dx, dy, dx, dy), strict=True))


def visible(box: Box, width: Column, height: Column) -> Column:
    """struct(x1, y1, x2, y2, visible): the box clipped to the image, and the share of it that is left."""
    inside = clip(box, width, height)
    whole = (box[2] - box[0]) * (box[3] - box[1])
    return F.struct(*[v.alias(n) for v, n in zip(inside, ("x1", "y1", "x2", "y2"), strict=True)], F.try_divide(area(inside), whole).alias("visible"))
