"""Geometric augmentation of images as a plan: which attempt is taken, and where it puts the boxes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import matrices as m

# The least visible share of a box, and for rare ones; the least side of a box in pixels.
MIN_VISIBILITY, RARE_VISIBILITY, LEAST_SIDE = 0.25, 0.2, 20.0
#: Ranges that an attempt draws from: turn in degrees, scale, shift in shares of the image, perspective.
TURN, SCALE, SHIFT, PERSPECTIVE = 15.0, (0.7, 1.3), 0.2, 0.4
CORNERS = ("x1", "y1", "x2", "y2")


def drawn(key: int | str, attempt: int, what: str) -> float:
    """A number in 0..1 for an attempt, the same in any engine that has md5."""
    return int(md5(f"{key}/{attempt}/{what}".encode()).hexdigest()[:8], 16) / 2**32


def transform(key: int | str, attempt: int, width: float, height: float) -> np.ndarray:
    """Mirror, then turn, scale and shift, then perspective, all about the centre, as one matrix."""
    u = lambda what: drawn(key, attempt, what)
    cx, cy = width / 2, height / 2
    return m.then(
        m.about(m.mirror(u("mirror") < 0.5), cx, cy),
        m.about(m.turn((u("turn") - 0.5) * (2 * TURN), u("scale") * (SCALE[1] - SCALE[0]) + SCALE[0]), cx, cy),
        m.shift((u("dx") - 0.5) * (2 * SHIFT) * width, (u("dy") - 0.5) * (2 * SHIFT) * height),
        m.about(m.perspective((u("px") - 0.5) * PERSPECTIVE / width, (u("py") - 0.5) * PERSPECTIVE / height), cx, cy),
    )


def first_passing(key: int | str, boxes: np.ndarray, least: np.ndarray, width: float, height: float, tries: int) -> tuple[int, np.ndarray | None, np.ndarray | None]:
    """How many attempts are made, which boxes the passing one keeps, and where they are with their visible share. An attempt
    is worked out only if the one before failed."""
    for k in range(1, tries + 1):
        to = m.moved(transform(key, k, width, height), boxes)
        inside = np.column_stack([np.maximum(0.0, to[:, :2]), np.minimum([width, height], to[:, 2:])])
        size = lambda x: x[:, 2:] - x[:, :2]
        with np.errstate(invalid="ignore", divide="ignore"):
            visible = np.maximum(0.0, size(inside)).prod(axis=1) / size(to).prod(axis=1)
        kept = visible >= least
        if kept.any() and (size(inside)[kept] >= LEAST_SIDE).all():
            return k, kept, np.column_stack([inside, visible])
    return tries, None, None


def plan(boxes: DataFrame, width: float, height: float, tries: int = 3, key: str = "image_id", idx: str = "box_id", rare: Column | None = None) -> DataFrame:
    """A row an image: attempts made, failures, whether one was accepted, and then its boxes (idx, corners, visible share).

    An attempt moves all boxes of an image by one matrix and clips them; boxes that are too little visible go. It passes if
    a box is left and none is smaller than LEAST_SIDE. Attempt k is worked out only where k - 1 failed, at most
    ``tries``. An image's boxes are gathered in its row, once, as they pass or fail together; boxes with a null corner
    are left out, and repeated boxes are boxes like others. Images without boxes have no row.
    """
    item = F.struct(F.col(idx).cast("long").alias("idx"), *[F.col(c).cast("double").alias(c) for c in CORNERS], F.coalesce(rare if rare is not None else F.lit(False), F.lit(False)).alias("rare"))
    whole = boxes.dropna(subset=list(CORNERS)).groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("boxes"))
    kind = whole.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("idx", pa.int64()), *[(c, pa.float64()) for c in (*CORNERS, "visible")]])
        for batch in batches:
            attempts, placed = [], []
            for image, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = np.array([[x[c] for c in CORNERS] for x in found])
                least = np.where([x["rare"] for x in found], RARE_VISIBILITY, MIN_VISIBILITY)
                k, kept, new = first_passing(image, at, least, width, height, tries)
                attempts.append(k)
                placed.append(None if new is None else [{"idx": x["idx"], **dict(zip((*CORNERS, "visible"), v, strict=True))} for x, v, on in zip(found, new.tolist(), kept, strict=True) if on])
            accepted = [x is not None for x in placed]
            failures = [k - ok for k, ok in zip(attempts, accepted, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(attempts, pa.int32()), pa.array(failures, pa.int32()), pa.array(accepted), pa.array(placed, pa.list_(item))], [key, "attempts", "failures", "accepted", "placed"])

    return whole.mapInArrow(run, f"{key} {kind}, attempts int, failures int, accepted boolean, placed array<struct<idx:bigint,{','.join(f'{c}:double' for c in (*CORNERS, 'visible'))}>>")


def placed_boxes(plans: DataFrame, key: str = "image_id", idx: str = "box_id") -> DataFrame:
    """The boxes of the accepted attempts."""
    return plans.where("accepted").select(key, "attempts", F.explode("placed").alias("b")).select(key, F.col("b.idx").alias(idx), F.col("attempts").alias("attempt"), *[F.col(f"b.{c}").alias(c) for c in CORNERS], F.col("b.visible").alias("visible"))
