import random

import pytest
from pyspark.sql import functions as F

from boxloom.functions import geometry as g


def lits(*values):
    return [F.lit(v) for v in values]


def corners(box):
    return (box["x1"], box["y1"], box["x2"], box["y2"])


def convert(one, value, width, height, request=(None, None), **options):
    numbers = {k: F.lit(value.get(k)).cast("double") for k in ("x1", "y1", "x2", "y2", "x", "y", "width", "height")}
    (found,) = one(
        g.convert_value(
            tuple(numbers[k] for k in ("x1", "y1", "x2", "y2")),
            tuple(numbers[k] for k in ("x", "y", "width", "height")),
            F.lit({"x1", "y1", "x2", "y2"} <= set(value)),
            F.lit({"x", "y", "width", "height"} <= set(value)),
            F.lit(width),
            F.lit(height),
            F.lit(request[0]).cast("int"),
            F.lit(request[1]).cast("int"),
            **options,
        )
    )
    return found and (*corners(found["box"]), found["unit"])


RECT = dict(zip(("x", "y", "width", "height"), (10.0, 20.0, 30.0, 40.0)))


def rect(x, y, w, h):
    return {"x": x, "y": y, "width": w, "height": h}


@pytest.mark.parametrize(
    "value, size, request_size, expected",
    [
        (rect(10.0, 20.0, 30.0, 40.0), (1000, 500), (None, None), (100, 100, 400, 300, "labelstudio_percent_xywh")),
        (rect(500.0, 100.0, 50.0, 200.0), (1000, 500), (None, None), (500, 100, 550, 300, "pixel_xywh_auto_detected")),
        (rect(640.0, 100.0, 100.0, 300.0), (3840, 2160), (1280, 720), (1920, 300, 2220, 1200, "pixel_xywh_auto_detected")),
        (rect(80.0, 20.0, 15.0, 40.0), (1000, 500), (None, None), (800, 100, 950, 300, "labelstudio_percent_xywh")),
        ({"x1": 40.0, "y1": 10.0, "x2": 20.0, "y2": 30.0}, (1000, 500), (None, None), (200, 50, 400, 150, "percent_xyxy")),
        ({"x1": 140.0, "y1": 10.0, "x2": 20.0, "y2": 30.0}, (1000, 500), (0, 0), (20, 10, 140, 30, "pixel_xyxy")),
        ({"x": 1.0, "y": 2.0, "width": 3.0}, (100, 100), (None, None), None),
        (rect(1e300, 1e300, 1e300, 1e300), (100, 80), (None, None), (99, 79, 100, 80, "pixel_xywh_auto_detected")),
    ],
)
def test_units(one, value, size, request_size, expected):
    assert convert(one, value, *size, request_size) == expected


def test_configured_units(one):
    assert convert(one, RECT, 1000, 500, coordinate_units="pixel")[4] == "pixel_xywh_configured"
    big = rect(500.0, 100.0, 50.0, 200.0)
    assert convert(one, big, 1000, 500, coordinate_units="percent")[4] == "labelstudio_percent_xywh"
    assert convert(one, big, 1000, 500, auto_detect=False)[4] == "labelstudio_percent_xywh"


def test_expand_and_request_size(one):
    box = g.make_box(*lits(320, 180, 640, 920))
    grown, small, same = one(
        g.expand_box(box, *lits(1920, 1080), 0.05), g.request_size(*lits(200, 100), 100), g.request_size(*lits(9, 8), None)
    )
    assert corners(grown) == (304, 143, 656, 957)
    assert tuple(small) == (100, 50) and tuple(same) == (9, 8)


def test_rounding_is_half_even_everywhere(spark):
    """Random boxes against the rules written with Python's own rounding."""
    rng = random.Random(3)
    rows = [
        (rng.randrange(1, 4000), rng.randrange(1, 3000), rng.randrange(0, 400) / 4, rng.randrange(0, 400) / 4,
         rng.randrange(0, 400) / 4, rng.randrange(0, 400) / 4, rng.randrange(1, 2000), rng.randrange(1, 2000))
        for _ in range(500)
    ]
    frame = spark.createDataFrame(rows, "w int, h int, x double, y double, bw double, bh double, rw int, rh int")
    c = {name: F.col(name) for name in frame.columns}
    found = frame.select(
        "*",
        g.percent_box(c["x"], c["y"], c["bw"], c["bh"], c["w"], c["h"]).alias("percent"),
        g.pixel_rect(c["x"], c["y"], c["bw"], c["bh"], c["rw"], c["rh"], c["w"], c["h"]).alias("pixel"),
    ).collect()

    def fit(edges, w, h):
        x1, y1 = max(0, min(w - 1, round(edges[0]))), max(0, min(h - 1, round(edges[1])))
        return x1, y1, max(x1 + 1, min(w, round(edges[2]))), max(y1 + 1, min(h, round(edges[3])))

    for r in found:
        full = (r.w * r.x / 100, r.h * r.y / 100, r.w * (r.x + r.bw) / 100, r.h * (r.y + r.bh) / 100)
        assert corners(r.percent) == fit(full, r.w, r.h)
        inner = fit((r.x, r.y, r.x + r.bw, r.y + r.bh), r.rw, r.rh)
        sx, sy = r.w / r.rw, r.h / r.rh
        scaled = fit((inner[0] * sx, inner[1] * sy, inner[2] * sx, inner[3] * sy), r.w, r.h)
        assert corners(r.pixel) == (inner if (r.rw, r.rh) == (r.w, r.h) else scaled)
