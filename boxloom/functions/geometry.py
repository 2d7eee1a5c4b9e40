"""Integer corner boxes: unit conversion, rescaling, cropping and percent export.

Coordinates round half to even (`rint`), and are clamped as doubles before the cast so that
absurd model output cannot overflow an INT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxloom.functions.columns import let, null, positive_or

UNIT = "struct<box:struct<format:string,x1:int,y1:int,x2:int,y2:int>,unit:string>"
PIXEL_UNITS = {"pixel", "pixels", "xywh_pixel"}
PERCENT_UNITS = {"percent", "percentage", "labelstudio"}


def make_box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(
        F.lit("xyxy").alias("format"),
        x1.cast("int").alias("x1"),
        y1.cast("int").alias("y1"),
        x2.cast("int").alias("x2"),
        y2.cast("int").alias("y2"),
    )


def _low(value: Column, size: Column) -> Column:
    """First pixel of an edge: inside 0 .. size-1."""
    return F.greatest(F.lit(0.0), F.least(size.cast("double") - 1.0, F.rint(value))).cast("int")


def _high(value: Column, low: Column, size: Column) -> Column:
    """Last edge: at most `size`, and at least one pixel past the first."""
    return F.greatest(low + 1, F.least(size.cast("double"), F.rint(value)).cast("int"))


def _fit(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    left, top = _low(x1, width), _low(y1, height)
    return make_box(left, top, _high(x2, left, width), _high(y2, top, height))


def percent_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Percent x, y, width, height of the image to a corner box."""
    full_w, full_h = width.cast("double"), height.cast("double")
    return _fit(
        full_w * x / 100.0,
        full_h * y / 100.0,
        full_w * (x + w) / 100.0,
        full_h * (y + h) / 100.0,
        width,
        height,
    )


def scale_box(box: Column, from_w: Column, from_h: Column, to_w: Column, to_h: Column) -> Column:
    """Corner box from one image size to another; equal sizes return the box untouched."""
    across, down = to_w / from_w.cast("double"), to_h / from_h.cast("double")
    scaled = _fit(
        box.getField("x1") * across,
        box.getField("y1") * down,
        box.getField("x2") * across,
        box.getField("y2") * down,
        to_w,
        to_h,
    )
    return F.when((from_w == to_w) & (from_h == to_h), box).otherwise(scaled)


def pixel_rect(
    x: Column, y: Column, w: Column, h: Column, from_w: Column, from_h: Column, to_w: Column, to_h: Column
) -> Column:
    """Pixel x, y, width, height in request space to a corner box in image space."""
    return let(
        _fit(x, y, x + w, y + h, from_w, from_h),
        lambda box: scale_box(box, from_w, from_h, to_w, to_h),
    )


def corners_are_percent(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(F.abs(x1), F.abs(y1), F.abs(x2), F.abs(y2)) <= 100.0


def corner_box(
    x1: Column,
    y1: Column,
    x2: Column,
    y2: Column,
    width: Column,
    height: Column,
    request_w: Column,
    request_h: Column,
) -> Column:
    """Two corners, in any order: percent while no coordinate exceeds 100, else request pixels."""
    left, right = F.least(x1, x2), F.greatest(x1, x2)
    top, bottom = F.least(y1, y2), F.greatest(y1, y2)
    full_w, full_h = width.cast("double"), height.cast("double")
    from_percent = _fit(
        full_w * left / 100.0,
        full_h * top / 100.0,
        full_w * right / 100.0,
        full_h * bottom / 100.0,
        width,
        height,
    )
    from_pixels = let(
        _fit(left, top, right, bottom, request_w, request_h),
        lambda box: scale_box(box, request_w, request_h, width, height),
    )
    return F.when(corners_are_percent(x1, y1, x2, y2), from_percent).otherwise(from_pixels)


def convert_value(
    corners: tuple[Column, Column, Column, Column],
    rect: tuple[Column, Column, Column, Column],
    has_corners: Column,
    has_rect: Column,
    width: Column,
    height: Column,
    request_width: Column | None = None,
    request_height: Column | None = None,
    coordinate_units: str = "auto",
    auto_detect: bool = True,
) -> Column:
    """Box plus unit tag from whichever notation the value uses.

    Corner fields win over x/y/width/height. Null when fields are missing or not numeric.
    """
    from_w = width if request_width is None else positive_or(request_width, width)
    from_h = height if request_height is None else positive_or(request_height, height)
    units = (coordinate_units or "auto").lower()

    def tagged(box: Column, unit: Column) -> Column:
        return F.struct(box.alias("box"), unit.alias("unit"))

    def numeric(values: tuple[Column, ...]) -> Column:
        usable = F.lit(True)
        for value in values:
            usable = usable & value.isNotNull() & ~F.isnan(value)
        return usable

    corner_form = tagged(
        corner_box(*corners, width, height, from_w, from_h),
        F.when(corners_are_percent(*corners), F.lit("percent_xyxy")).otherwise(F.lit("pixel_xyxy")),
    )
    percent_form = tagged(percent_box(*rect, width, height), F.lit("labelstudio_percent_xywh"))

    def pixel_form(tag: str) -> Column:
        return tagged(pixel_rect(*rect, from_w, from_h, width, height), F.lit(tag))

    if units in PIXEL_UNITS:
        rect_form = pixel_form("pixel_xywh_configured")
    elif units in PERCENT_UNITS or not auto_detect:
        rect_form = percent_form
    else:
        over = F.greatest(*rect) > 100.0
        rect_form = F.when(over, pixel_form("pixel_xywh_auto_detected")).otherwise(percent_form)
    return (
        F.when(has_corners, F.when(numeric(corners), corner_form))
        .when(has_rect & numeric(rect), rect_form)
        .otherwise(null(UNIT))
    )


def expand_box(box: Column, width: Column, height: Column, ratio: float) -> Column:
    """Grow by `ratio` of the box size on every side, clipped to the image."""
    x1, y1, x2, y2 = (box.getField(name) for name in ("x1", "y1", "x2", "y2"))
    pad_x = F.rint((x2 - x1) * F.lit(float(ratio))).cast("int")
    pad_y = F.rint((y2 - y1) * F.lit(float(ratio))).cast("int")
    return make_box(
        F.greatest(F.lit(0), x1 - pad_x),
        F.greatest(F.lit(0), y1 - pad_y),
        F.least(width, x2 + pad_x),
        F.least(height, y2 + pad_y),
    )


def request_size(width: Column, height: Column, max_side: int | None) -> Column:
    """Size of the image sent to a model when its longer side is capped."""
    longest = F.greatest(width, height)
    as_is = F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"))
    if max_side is None or max_side <= 0:
        return as_is
    scale = F.lit(float(max_side)) / longest.cast("double")

    def shrink(side: Column) -> Column:
        return F.greatest(F.lit(1), F.rint(side * scale).cast("int"))

    shrunk = F.struct(shrink(width).alias("width"), shrink(height).alias("height"))
    return F.when(longest <= max_side, as_is).otherwise(shrunk)


def percent_rect(box: Column, width: Column, height: Column) -> Column:
    """Corner box to percent x, y, width, height as labeling tools store it."""

    def share(part: Column, whole: Column) -> Column:
        percent = part.cast("double") / whole.cast("double") * 100.0
        return F.greatest(F.lit(0.0), F.least(F.lit(100.0), percent))

    x1, y1, x2, y2 = (box.getField(name) for name in ("x1", "y1", "x2", "y2"))
    return F.struct(
        share(x1, width).alias("x"),
        share(y1, height).alias("y"),
        share(x2 - x1, width).alias("width"),
        share(y2 - y1, height).alias("height"),
        F.lit(0).alias("rotation"),
    )


def box_width(box: Column) -> Column:
    return box.getField("x2") - box.getField("x1")


def box_height(box: Column) -> Column:
    return box.getField("y2") - box.getField("y1")


def aspect_ratio(width: Column, height: Column) -> Column:
    """Longer side over shorter; null for an empty side."""
    w, h = width.cast("double"), height.cast("double")
    return F.when((w > 0) & (h > 0), F.greatest(w / h, h / w))
