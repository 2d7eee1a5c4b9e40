"""Boxes: every line item is one detected box."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import geometry as g
from boxloom.operators import boxes
from boxloom.params import BoxFilter, CropGuard
from catalog.inputs import Tables, with_inputs
from catalog.registry import query

MAX_SIDE = 1280
CORNERS = ["x1", "y1", "x2", "y2"]


def low(value: str, size: str) -> str:
    return (
        f"CAST(greatest(CAST(0 AS DOUBLE), least(CAST({size} AS DOUBLE) - 1, round_even({value}, 0))) AS INT)"
    )


def high(value: str, first: str, size: str) -> str:
    return f"greatest({first} + 1, CAST(least(CAST({size} AS DOUBLE), round_even({value}, 0)) AS INT))"


def fit(x1: str, y1: str, x2: str, y2: str, width: str, height: str, prefix: str = "") -> str:
    left, top = low(x1, width), low(y1, height)
    return (
        f"{left} AS {prefix}x1, {top} AS {prefix}y1, {high(x2, left, width)} AS {prefix}x2, "
        f"{high(y2, top, height)} AS {prefix}y2"
    )


def percent_fit(width: str = "width", height: str = "height") -> str:
    hundred = "CAST(100 AS DOUBLE)"
    w, h = f"CAST({width} AS DOUBLE)", f"CAST({height} AS DOUBLE)"
    return fit(
        f"({w} * x / {hundred})",
        f"({h} * y / {hundred})",
        f"({w} * (x + bw) / {hundred})",
        f"({h} * (y + bh) / {hundred})",
        width,
        height,
    )


REQUEST = f"""CASE WHEN greatest(width, height) <= {MAX_SIDE} THEN width ELSE greatest(1, CAST(round_even(
    width * (CAST({MAX_SIDE} AS DOUBLE) / greatest(width, height)), 0) AS INT)) END AS rw,
  CASE WHEN greatest(width, height) <= {MAX_SIDE} THEN height ELSE greatest(1, CAST(round_even(
    height * (CAST({MAX_SIDE} AS DOUBLE) / greatest(width, height)), 0) AS INT)) END AS rh"""
# pixel boxes live in the resized request image
PIXEL = {"x": "x * 13", "y": "y * 13", "bw": "bw * 13", "bh": "bh * 13"}
PIXEL_SQL = f"""SELECT sample_id, line, width, height, {REQUEST}, x * 13 AS x, y * 13 AS y, bw * 13 AS bw,
  bh * 13 AS bh FROM fx_boxes"""


def scale(prefix: str = "s") -> str:
    """Request box s.. back to the image; same size keeps it."""
    across, down = "(width / CAST(rw AS DOUBLE))", "(height / CAST(rh AS DOUBLE))"
    left, top = low(f"({prefix}x1 * {across})", "width"), low(f"({prefix}y1 * {down})", "height")
    right, bottom = (
        high(f"({prefix}x2 * {across})", left, "width"),
        high(f"({prefix}y2 * {down})", top, "height"),
    )
    return ", ".join(
        f"CASE WHEN rw = width AND rh = height THEN {prefix}{name} ELSE {text} END AS {name}"
        for name, text in zip(CORNERS, (left, top, right, bottom))
    )


def requested(t: Tables, pixels: bool = True) -> DataFrame:
    size = g.request_size(F.col("width"), F.col("height"), MAX_SIDE)
    rows = t.boxes.withColumn("_size", size).select(
        "*", F.col("_size.width").alias("rw"), F.col("_size.height").alias("rh")
    )
    return rows.withColumns({name: F.expr(text) for name, text in PIXEL.items()}) if pixels else rows


def cols(*names: str) -> list:
    return [F.col(name) for name in names]


def flat(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("sample_id", "line", *more, *[F.col(f"box.{name}").alias(name) for name in CORNERS])


@query("g1_percent_box", with_inputs(f"SELECT sample_id, line, {percent_fit()} FROM fx_boxes", "fx_boxes"))
def g1(t: Tables) -> DataFrame:
    return flat(t.boxes.withColumn("box", g.percent_box(*cols("x", "y", "bw", "bh", "width", "height"))))


@query(
    "g2_pixel_rect",
    with_inputs(
        f"""SELECT sample_id, line, {scale()} FROM (SELECT *,
          {fit("x", "y", "(x + bw)", "(y + bh)", "rw", "rh", "s")} FROM ({PIXEL_SQL}))""",
        "fx_boxes",
    ),
)
def g2(t: Tables) -> DataFrame:
    box = g.pixel_rect(*cols("x", "y", "bw", "bh", "rw", "rh", "width", "height"))
    return flat(requested(t).withColumn("box", box))


@query(
    "g3_scale_box",
    with_inputs(
        f"""SELECT sample_id, line, {scale()} FROM (SELECT *, CAST(x AS INT) AS sx1, CAST(y AS INT) AS sy1,
          CAST(x AS INT) + CAST(bw AS INT) AS sx2, CAST(y AS INT) + CAST(bh AS INT) AS sy2 FROM (
          SELECT sample_id, line, width, height, {REQUEST}, floor(x) * 13 AS x, y * 13 AS y, bw * 13 AS bw,
          round_even(bh, 0) * 13 AS bh FROM fx_boxes))""",
        "fx_boxes",
    ),
)
def g3(t: Tables) -> DataFrame:
    whole = requested(t, pixels=False).selectExpr(
        "sample_id", "line", "width", "height", "rw", "rh",
        "CAST(floor(x) * 13 AS INT) AS x", "CAST(y * 13 AS INT) AS y",
        "CAST(bw * 13 AS INT) AS bw", "CAST(rint(bh) * 13 AS INT) AS bh",
    )
    box = g.make_box(F.col("x"), F.col("y"), F.col("x") + F.col("bw"), F.col("y") + F.col("bh"))
    return flat(whole.withColumn("box", g.scale_box(box, *cols("rw", "rh", "width", "height"))))


# corners: every third box in percent, the others in request pixels, odd suppliers with swapped corners
CORNER_SQL = f"""SELECT *, CASE WHEN line % 3 = 0 THEN 1 ELSE 13 END AS f, {REQUEST} FROM fx_boxes"""
CORNER_VALUES = {
    "cx1": "CASE WHEN y % 2 = 1 THEN (x + bw) * f ELSE x * f END",
    "cy1": "y * f",
    "cx2": "CASE WHEN y % 2 = 1 THEN x * f ELSE (x + bw) * f END",
    "cy2": "(y + bh) * f",
}
CORNER_SELECT = ", ".join(f"{text} AS {name}" for name, text in CORNER_VALUES.items())
_W, _H, _C = "CAST(width AS DOUBLE)", "CAST(height AS DOUBLE)", "CAST(100 AS DOUBLE)"
IS_PERCENT = "greatest(abs(cx1), abs(cy1), abs(cx2), abs(cy2)) <= 100"
CORNER_FIT = f"""SELECT sample_id, line, CASE WHEN {IS_PERCENT} THEN 'percent_xyxy' ELSE 'pixel_xyxy' END AS unit,
  {", ".join(f"CASE WHEN {IS_PERCENT} THEN p{name} ELSE {name} END AS {name}" for name in CORNERS)}
  FROM (SELECT *, {scale()} FROM (SELECT *,
    {fit(f"least({_W}*cx1/{_C},{_W}*cx2/{_C})", f"least({_H}*cy1/{_C},{_H}*cy2/{_C})",
         f"greatest({_W}*cx1/{_C},{_W}*cx2/{_C})", f"greatest({_H}*cy1/{_C},{_H}*cy2/{_C})", "width", "height", "p")},
    {fit("least(cx1,cx2)", "least(cy1,cy2)", "greatest(cx1,cx2)", "greatest(cy1,cy2)", "rw", "rh", "s")}
  FROM (SELECT *, {CORNER_SELECT} FROM ({CORNER_SQL}))))"""


def corner_rows(t: Tables) -> DataFrame:
    rows = requested(t, pixels=False).withColumn("f", F.expr("CASE WHEN line % 3 = 0 THEN 1 ELSE 13 END"))
    return rows.withColumns({name: F.expr(text) for name, text in CORNER_VALUES.items()})


@query(
    "g4_corner_box",
    with_inputs(f"SELECT sample_id, line, x1, y1, x2, y2 FROM ({CORNER_FIT})", "fx_boxes"),
)
def g4(t: Tables) -> DataFrame:
    box = g.corner_box(*cols("cx1", "cy1", "cx2", "cy2", "width", "height", "rw", "rh"))
    return flat(corner_rows(t).withColumn("box", box))


# line 1: corners; line 2: nothing usable; others: x/y/width/height, percent or pixels by size
@query(
    "g5_unit_dispatch",
    with_inputs(
        f"""SELECT sample_id, line, unit, x1, y1, x2, y2 FROM ({CORNER_FIT}) WHERE line = 1
        UNION ALL SELECT sample_id, line, NULL, NULL, NULL, NULL, NULL FROM fx_boxes WHERE line = 2
        UNION ALL SELECT sample_id, line,
          CASE WHEN over THEN 'pixel_xywh_auto_detected' ELSE 'labelstudio_percent_xywh' END AS unit,
          CASE WHEN over THEN x1 ELSE px1 END, CASE WHEN over THEN y1 ELSE py1 END,
          CASE WHEN over THEN x2 ELSE px2 END, CASE WHEN over THEN y2 ELSE py2 END
        FROM (SELECT *, {scale()} FROM (SELECT *, greatest(x, y, bw, bh) > 100 AS over,
          {fit("x", "y", "(x + bw)", "(y + bh)", "rw", "rh", "s")},
          {fit(f"({_W}*x/{_C})", f"({_H}*y/{_C})", f"({_W}*(x+bw)/{_C})", f"({_H}*(y+bh)/{_C})", "width", "height", "p")}
          FROM (SELECT sample_id, line, width, height, {REQUEST}, x * f AS x, y * f AS y, bw * f AS bw, bh * f AS bh
            FROM (SELECT *, CASE WHEN line % 3 = 0 THEN 1 ELSE 13 END AS f FROM fx_boxes WHERE line > 2))))""",
        "fx_boxes",
    ),
)
def g5(t: Tables) -> DataFrame:
    rows = corner_rows(t)
    has_corners, has_rect = F.col("line") == 1, F.col("line") != 2
    rect = tuple(F.expr(f"{name} * f") for name in ("x", "y", "bw", "bh"))
    converted = g.convert_value(
        tuple(cols("cx1", "cy1", "cx2", "cy2")), rect, has_corners, has_rect, *cols("width", "height", "rw", "rh")
    )
    out = rows.withColumn("_c", converted)
    return flat(out.withColumn("box", F.col("_c.box")).withColumn("unit", F.col("_c.unit")), "unit")


BOX_SQL = f"SELECT *, {percent_fit()} FROM fx_boxes"
CROP_SQL = f"""SELECT *, greatest(0, x1 - px) AS c1, greatest(0, y1 - py) AS c2, least(width, x2 + px) AS c3,
  least(height, y2 + py) AS c4 FROM (SELECT *, CAST(round_even((x2 - x1) * CAST(0.05 AS DOUBLE), 0) AS INT) AS px,
  CAST(round_even((y2 - y1) * CAST(0.05 AS DOUBLE), 0) AS INT) AS py FROM ({BOX_SQL}))"""


def boxed(t: Tables) -> DataFrame:
    return t.boxes.withColumn("box", g.percent_box(*cols("x", "y", "bw", "bh", "width", "height")))


@query(
    "g6_expand_box",
    with_inputs(f"SELECT sample_id, line, c1 AS x1, c2 AS y1, c3 AS x2, c4 AS y2 FROM ({CROP_SQL})", "fx_boxes"),
)
def g6(t: Tables) -> DataFrame:
    rows = boxed(t)
    return flat(rows.withColumn("box", g.expand_box(F.col("box"), *cols("width", "height"), 0.05)))


@query(
    "g8_crop_metadata",
    with_inputs(
        f"""SELECT sample_id, line, concat(sample_id, '_obj_', line) AS crop_id,
        concat('crops/', sample_id, '_obj_', line, '.jpg') AS crop_uri, CAST(0.05 AS DOUBLE) AS crop_expand_ratio,
        true AS is_valid_crop, c1 AS x1, c2 AS y1, c3 AS x2, c4 AS y2 FROM ({CROP_SQL})""",
        "fx_boxes",
    ),
)
def g8(t: Tables) -> DataFrame:
    crop = boxes.crop_struct(
        F.col("sample_id"),
        F.concat(F.lit("obj_"), F.col("line")),
        F.col("box"),
        *cols("width", "height"),
        "crops/",
        0.05,
    )
    out = boxed(t).withColumn("crop", crop).withColumn("box", F.col("crop.crop_box"))
    named = out.withColumns({n: F.col(f"crop.{n}") for n in ("crop_id", "crop_uri", "crop_expand_ratio", "is_valid_crop")})
    return flat(named, "crop_id", "crop_uri", "crop_expand_ratio", "is_valid_crop")


@query("g9_request_size", with_inputs(f"SELECT sample_id, line, {REQUEST} FROM fx_boxes", "fx_boxes"))
def g9(t: Tables) -> DataFrame:
    return requested(t, pixels=False).select("sample_id", "line", "rw", "rh")


@query(
    "g10_percent_rect",
    with_inputs(
        f"""SELECT sample_id, line,
        {", ".join(f"greatest(CAST(0 AS DOUBLE), least({_C}, CAST({part} AS DOUBLE) / CAST({size} AS DOUBLE) * {_C})) AS {name}"
                   for name, part, size in (("px", "x1", "width"), ("py", "y1", "height"),
                                            ("pw", "(x2 - x1)", "width"), ("ph", "(y2 - y1)", "height")))},
        0 AS rotation FROM ({BOX_SQL})""",
        "fx_boxes",
    ),
)
def g10(t: Tables) -> DataFrame:
    out = boxed(t).withColumn("r", g.percent_rect(F.col("box"), *cols("width", "height")))
    return out.selectExpr(
        "sample_id", "line", "r.x AS px", "r.y AS py", "r.width AS pw", "r.height AS ph", "r.rotation AS rotation"
    )


@query(
    "g12_aspect_ratio",
    with_inputs(
        f"""SELECT sample_id, line, greatest(CAST(w AS DOUBLE) / h, CAST(h AS DOUBLE) / w) AS aspect
        FROM (SELECT sample_id, line, x2 - x1 AS w, y2 - y1 AS h FROM ({BOX_SQL}))""",
        "fx_boxes",
    ),
)
def g12(t: Tables) -> DataFrame:
    box = F.col("box")
    return boxed(t).select("sample_id", "line", g.aspect_ratio(g.box_width(box), g.box_height(box)).alias("aspect"))


SHIPPED = BoxFilter(min_confidence=0.05, min_width=12, min_height=24, min_area=300, max_aspect_ratio=8.0)
REASON_SQL = """CASE WHEN confidence < 0.05 THEN 'low_confidence' WHEN w <= 0 OR h <= 0 THEN 'invalid_box'
  WHEN w < 12 OR h < 24 OR CAST(w AS BIGINT) * h < 300 THEN 'tiny_box'
  WHEN greatest(CAST(w AS DOUBLE) / h, CAST(h AS DOUBLE) / w) > 8 THEN 'extreme_aspect_ratio' END"""
# raw corners, unclamped, so that empty boxes occur
RAW_SQL = """SELECT sample_id, line, confidence, x, y, bw, bh, CAST(bw AS INT) * 3 AS w,
  CAST(round_even(bh, 0) AS INT) AS h FROM fx_boxes"""


def raw_boxes(t: Tables) -> DataFrame:
    x, y = F.floor("x").cast("int"), F.col("y").cast("int")
    box = g.make_box(x, y, x + F.col("bw").cast("int") * 3, y + F.rint("bh").cast("int"))
    return t.boxes.withColumn("box", box)


@query(
    "p8_box_filter",
    with_inputs(
        f"""SELECT sample_id, line, w, h, reason FROM (SELECT *, coalesce({REASON_SQL}, 'kept') AS reason
        FROM ({RAW_SQL}))""",
        "fx_boxes",
    ),
)
def p8(t: Tables) -> DataFrame:
    box = F.col("box")
    reason = boxes.drop_reason(F.col("confidence"), box, SHIPPED)
    return raw_boxes(t).select(
        "sample_id",
        "line",
        g.box_width(box).alias("w"),
        g.box_height(box).alias("h"),
        F.coalesce(reason, F.lit("kept")).alias("reason"),
    )


@query(
    "p15_crop_guard",
    with_inputs(
        f"""SELECT sample_id, line, CASE WHEN w < 4 OR h < 4 THEN 'crop 尺寸过小，跳过 VLM 分类'
        WHEN greatest(CAST(w AS DOUBLE) / h, CAST(h AS DOUBLE) / w) > 20 THEN 'crop 长宽比异常，跳过 VLM 分类' END AS problem
        FROM ({RAW_SQL})""",
        "fx_boxes",
    ),
)
def p15(t: Tables) -> DataFrame:
    return raw_boxes(t).select("sample_id", "line", boxes.crop_problem(F.col("box"), CropGuard()).alias("problem"))
