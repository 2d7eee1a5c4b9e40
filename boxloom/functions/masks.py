"""Run-length masks: alternating runs of background and foreground down the columns, starting with background.

`rle` holds the runs as a JSON list, `coco_rle` as text: every run but the first three as its difference to the run two
places before, in groups of five bits, least first, with a flag for more groups, shifted into printable letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

_LONGEST = 12  # groups of five bits in a 64-bit number


def _chains(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each run in its mask, and the order that puts the runs of one mask and parity side by side."""
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(firsts, sizes)
    mask = np.repeat(np.arange(len(sizes)), sizes)
    # the first run stands alone, as a parity of its own
    parity = np.where(place == 0, 2, place % 2)
    return place, np.lexsort((place, parity, mask))


def decode_texts(texts: list[str | None]) -> list[np.ndarray | None]:
    """The runs of many masks at once; None for null and broken texts."""
    raw = [t.encode("latin-1", "replace") if t is not None else b"" for t in texts]
    codes = [np.frombuffer(r, np.uint8).astype(np.int64) - 48 for r in raw]
    good = [t is not None and bool(len(c) == 0 or (c.min() >= 0 and c.max() < 64 and not c[-1] & 32)) for t, c in zip(texts, codes, strict=True)]
    code = np.concatenate([c for c, ok in zip(codes, good, strict=True) if ok] or [np.zeros(0, np.int64)])
    ends = np.flatnonzero(~(code & 32).astype(bool))
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    group = np.arange(len(code)) - np.repeat(starts, ends - starts + 1)
    # a run of more groups than a number holds is no run
    code = np.where(group < _LONGEST, code, 0)
    value = np.add.reduceat((code & 31) << (5 * np.minimum(group, _LONGEST)), starts) if len(starts) else starts
    value = np.where(code[ends] & 16, value - (np.int64(1) << (5 * np.minimum(group[ends] + 1, _LONGEST))), value)
    lengths = np.array([len(c) for c, ok in zip(codes, good, strict=True) if ok], np.int64)
    last = np.cumsum(lengths)
    sizes = np.diff(np.r_[0, np.searchsorted(ends, last)])
    place, order = _chains(sizes)
    moved, fresh = value[order], place[order] <= 2
    total = np.cumsum(moved)
    chain = np.flatnonzero(fresh)
    before = np.repeat(total[chain] - moved[chain], np.diff(np.r_[chain, len(moved)]))
    runs = np.empty_like(value)
    runs[order] = total - before
    found = iter(np.split(runs, np.cumsum(sizes)[:-1]) if len(sizes) else [])
    return [next(found) if ok else None for ok in good]


def encode_runs(masks: list[np.ndarray | None]) -> list[str | None]:
    """The texts of many masks at once."""
    held = [np.asarray(m, np.int64) if m is not None else np.zeros(0, np.int64) for m in masks]
    sizes = np.array([len(m) for m in held], np.int64)
    value = np.concatenate(held or [np.zeros(0, np.int64)])
    place, _ = _chains(sizes)
    far = np.flatnonzero(place > 2)
    left = value.copy()
    left[far] -= value[far - 2]
    letters, used, more = np.zeros((len(left), 13), np.uint8), np.zeros(len(left), np.int64), np.ones(len(left), bool)
    for k in range(13):
        code = left & 31
        left = np.where(more, left >> 5, left)
        again = np.where(code & 16, left != -1, left != 0)
        letters[:, k] = np.where(again, code | 32, code) + 48
        used += more
        more &= again
        if not more.any():
            break
    text = letters[np.arange(13) < used[:, None]].tobytes().decode("ascii")
    ends = np.r_[0, np.cumsum(used)][np.r_[0, np.cumsum(sizes)]].tolist()
    return [None if m is None else text[a:b] for m, a, b in zip(masks, ends, ends[1:], strict=False)]


@F.pandas_udf(ArrayType(LongType()))
def decode_coco(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Runs of `coco_rle` texts; null for null and broken ones."""
    for batch in texts:
        yield pd.Series(decode_texts([None if pd.isna(t) else t for t in batch]), dtype=object)


@F.pandas_udf(StringType())
def encode_coco(runs: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in runs:
        yield pd.Series(encode_runs(list(batch)), dtype=object)


def runs_of(mask_format: Column, counts: Column) -> Column:
    """Runs of a mask in either format; null for other formats and broken texts."""
    listed = F.from_json(F.when(mask_format == "rle", counts), "array<bigint>")
    return F.coalesce(listed, decode_coco(F.when(mask_format == "coco_rle", counts)))


def mask_stats(runs: Column, height: Column, width: Column) -> Column:
    """Struct of area and x, y, width, height of the smallest box around the foreground (null without foreground).

    Null where runs are missing or negative or do not fill height times width.
    """
    high = height.cast("bigint")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    start = F.struct(zero.alias("at"), zero.alias("area"), none.alias("x1"), none.alias("y1"), none.alias("x2"), none.alias("y2"))
    placed = F.transform(runs, lambda n, i: F.struct(n.alias("n"), (i % 2 == 1).alias("on")))

    def step(state: Column, run: Column) -> Column:
        at, n = state.getField("at"), run.getField("n")
        end, here = at + n - 1, run.getField("on") & (n > 0)
        left, right = F.floor(at / high), F.floor(end / high)
        single = left == right

        def wider(name: str, value: Column, pick) -> Column:
            return F.when(here, pick(state.getField(name), value)).otherwise(state.getField(name)).alias(name)

        return F.struct(
            (at + n).alias("at"),
            (state.getField("area") + F.when(here, n).otherwise(zero)).alias("area"),
            wider("x1", left, F.least),
            wider("y1", F.when(single, at % high).otherwise(zero), F.least),
            wider("x2", right, F.greatest),
            wider("y2", F.when(single, end % high).otherwise(high - 1), F.greatest),
        )

    fits = F.forall(runs, lambda n: n.isNotNull() & (n >= 0)) & (F.aggregate(runs, zero, lambda a, n: a + n) == high * width) & (high > 0)

    def finish(state: Column) -> Column:
        x, y = state.getField("x1"), state.getField("y1")
        return F.struct(
            state.getField("area").alias("area"), x.alias("x"), y.alias("y"),
            (state.getField("x2") - x + 1).alias("width"), (state.getField("y2") - y + 1).alias("height"),
        )

    return F.when(fits, F.aggregate(placed, start, step, finish))


def polygon_area(polygon: Column) -> Column:
    """Area inside a simple polygon of [x, y] points by the shoelace formula; null under three points or with a broken one."""
    points = F.size(polygon)
    turned = F.concat(F.slice(polygon, 2, F.greatest(points - 1, F.lit(0))), F.slice(polygon, 1, 1))
    cross = F.zip_with(polygon, turned, lambda p, q: F.get(p, F.lit(0)) * F.get(q, F.lit(1)) - F.get(q, F.lit(0)) * F.get(p, F.lit(1)))
    return F.when(points >= 3, F.abs(F.aggregate(cross, F.lit(0.0), lambda a, v: a + v)) / 2)
