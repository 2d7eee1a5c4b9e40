"""The keyed sample store: last write, branch union, snapshots, stale output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom import shared_path
from boxloom.operators import samples
from boxloom.operators.objects import to_documents, whole_samples
from boxloom.session import stored
from boxloom.sources import documents as files
from catalog import scenes as sc
from catalog.inputs import Tables
from catalog.registry import query

WRITES = {"sample_id": "concat('sample_', user_id)", "run_seq": "event_id", "status": "event_type", "amount": "value"}


@query(
    "w3_last_write",
    """SELECT concat('sample_', user_id) AS sample_id, max(event_id) AS run_seq, arg_max(event_type, event_id) AS status,
    arg_max(value, event_id) AS amount FROM events GROUP BY user_id""",
)
def w3(t: Tables) -> DataFrame:
    return samples.last_write_wins(t.derive("events", WRITES), ["sample_id"], [F.col("run_seq")])


@query(
    "w3_duplicate_ids",
    "SELECT concat('sample_', user_id) AS sample_id, count(*) AS n_rows FROM events GROUP BY user_id HAVING count(*) > 1",
)
def w3_duplicates(t: Tables) -> DataFrame:
    return samples.duplicate_ids(t.derive("events", WRITES))


@query(
    "w3_last_write_in_parts",
    f"""SELECT s.sample_id, CAST(s.k % 2 AS INT) AS run_seq, CAST(count(r.p) AS INT) AS n_objects FROM ({sc.SCENE_SQL}) s LEFT JOIN ({sc.KEPT_SQL}) r
    ON s.sample_id = r.sample_id AND (s.k % 2 = 0 OR r.p < 2) GROUP BY s.sample_id, s.k""",
)
def w3_in_parts(t: Tables) -> DataFrame:
    """Samples with an odd key are written again without their later part; nothing of it survives."""
    first = stored(sc.classified(t, part_size=2).withColumn("run_seq", F.lit(0)).withColumn("k", F.substring("sample_id", 8, 20).cast("bigint")), "first_run")
    again = first.filter("k % 2 = 1 AND part_no = 0").withColumn("run_seq", F.lit(1))
    kept = samples.last_write_wins(first.unionByName(again), ["sample_id"], [F.col("run_seq")])
    return whole_samples(kept).select("sample_id", "run_seq", F.size("objects").alias("n_objects"))


# generated samples: one per order with key and status; direct samples: one per line item's order
GEN = {"sample_id": "concat('sample_', o_orderkey)", "status": "concat('generated ', o_orderstatus)"}
DIRECT = {"sample_id": "concat('sample_', l_orderkey)", "status": "concat('direct ', l_linestatus)"}


@query(
    "u2_branch_union",
    """SELECT coalesce(d.sample_id, g.sample_id) AS sample_id, coalesce(d.status, g.status) AS status FROM
    (SELECT concat('sample_', o_orderkey) AS sample_id, concat('generated ', o_orderstatus) AS status FROM orders) g
    FULL JOIN (SELECT concat('sample_', l_orderkey) AS sample_id, max(concat('direct ', l_linestatus)) AS status FROM lineitem
      GROUP BY l_orderkey) d ON g.sample_id = d.sample_id""",
)
def u2(t: Tables) -> DataFrame:
    both = samples.union_branches(t.derive("orders", GEN), t.derive("lineitem", DIRECT))
    return samples.last_write_wins(both, ["sample_id"], [F.col("run_seq"), F.col("status")]).select(
        "sample_id", "status"
    )


@query(
    "j8_stale_samples",
    """SELECT concat('sample_', o_orderkey) AS sample_id, CASE WHEN o_orderstatus = 'O' THEN 'new' ELSE 'old' END AS written
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def j8(t: Tables) -> DataFrame:
    """Open orders were re-run, pending ones failed, the rest stay."""
    orders = t.derive("orders", {"sample_id": "concat('sample_', o_orderkey)", "status": "o_orderstatus"})
    store = orders.select("sample_id", F.lit("old").alias("written"))
    rerun = orders.filter("status = 'O'").select("sample_id", F.lit("new").alias("written"))
    failed = orders.filter("status = 'P'").select("sample_id")
    return samples.replace_samples(store, rerun, failed)


@query(
    "j8_stale_crops",
    f"""SELECT sample_id, concat('crops/', sample_id, '_', object_id, '.jpg') AS crop_uri FROM ({sc.NAMED_SQL})
    WHERE reason IS NOT NULL""",
)
def j8_crops(t: Tables) -> DataFrame:
    """Crops of a run without box filter that a run with it no longer has."""
    from boxloom.operators import boxes

    before = boxes.attach_crops(sc.detected(t), "crops", sc.RATIO)
    old = sc.object_rows(before).select("sample_id", F.col("o.crop.crop_uri").alias("crop_uri"))
    return samples.stale_crops(old, sc.cropped(t))


@query(
    "io8_store_snapshot",
    f"""SELECT s.sample_id, CASE WHEN source_type = 'cctv' THEN 'classified' ELSE 'cropped' END AS status,
    count(r.p) AS n_objects FROM ({sc.SCENE_SQL}) s LEFT JOIN ({sc.KEPT_SQL}) r ON s.sample_id = r.sample_id
    GROUP BY s.sample_id, source_type""".replace("source_type = 'cctv'", "s.source_type = 'cctv'").replace(
        "GROUP BY s.sample_id, source_type", "GROUP BY s.sample_id, s.source_type"
    ),
)
def io8(t: Tables) -> DataFrame:
    """A store snapshot written and read, the camera samples re-run on top, and the next snapshot."""
    first, second = shared_path(t.spark, "store"), shared_path(t.spark, "store")
    files.write_snapshot(to_documents(sc.cropped(t).drop("k")), first)
    store = files.read_samples(t.spark, first)
    rerun = samples.advance(store.filter("image_asset.source_type = 'cctv'"), "classified", sc.RUN.now)
    files.write_snapshot(samples.replace_samples(store, rerun), second)
    rows = files.read_samples(t.spark, second)
    return rows.select(
        "sample_id",
        F.col("workflow.workflow_status").alias("status"),
        F.size("objects").cast("bigint").alias("n_objects"),
    )
