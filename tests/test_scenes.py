"""What scenes are made from, and the work done once where it was done several times."""

import json

from pyspark.sql import functions as F

from boxloom.functions.columns import bind
from boxloom.functions.geometry import make_box
from boxloom.operators import classify, detect, objects, samples
from boxloom.params import RectangleService, Run
from catalog import scenes as sc
from catalog.inputs import Tables

RUN = Run(now="2026-05-08T10:00:00+08:00", now_utc="2026-05-08T02:00:00Z", pipeline_id="p", pipeline_version="test")


def logical(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_reply_texts_are_compiled(spark, tmp_path):
    spark.createDataFrame([(k,) for k in range(1, 13)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    told = sc.detection_replies(Tables(spark, str(tmp_path)))
    assert "lambda" not in logical(told)
    for row in told.collect():
        k, text = int(row.sample_id.removeprefix("sample_")), row.raw_text
        first, second = json.loads(text.removeprefix("Result: ").removesuffix(" end"))[0]["predictions"]
        found = [r for r in first["result"] + second["result"] if "id" in r and r["type"] == "rectanglelabels"]
        assert [r["value"]["x"] for r in found] == [(k * 31 + p * 17) % 700 / 10 for p in range(k % 4)]
        assert len(second["result"]) == (k % 4 == 3) and len(first["result"]) == 1 + min(k % 4, 2) + (k % 6 == 0)


def test_columns_used_up_are_not_passed_on(spark):
    rows = spark.createDataFrame([("a", "[1, 2]", 3)], "id string, text string, n int").withColumn("payload", F.try_parse_json("text"))
    bound = bind(rows, {"size": F.size(F.try_variant_get("payload", "$", "array<int>"))}, drop=("payload", "n"))
    assert bound.columns == ["id", "text", "size"] and bound.collect()[0]["size"] == 2


def test_an_identifier_is_formatted_once(spark):
    rows = spark.createDataFrame([("u", 100, 80)], "uri string, w int, h int")
    value = {"x": 1, "y": 1, "width": 50, "height": 50}
    result = [{"type": "rectanglelabels", "id": i, "value": value} for i in ("r1", "unique_id", 7, None)]
    payload = F.parse_json(F.lit(json.dumps({"predictions": [{"result": result}]})))
    none = F.lit(None).cast("int")
    found = detect.rectangle_objects(payload, F.col("uri"), F.col("w"), F.col("h"), RectangleService(object_id_prefix="obj"), none, none)
    out = rows.select(found.alias("f")).select("f.objects")
    assert out._jdf.queryExecution().logical().toString().count("format_string") <= 1
    made = out.collect()[0].objects
    assert [o.object_id for o in made] == ["r1", "obj_000002", "obj_000003", "obj_000004"]
    assert [o.crop.crop_id for o in made] == [f"{o.object_id}_crop" for o in made]


def test_parts_of_ordinary_and_odd_positions(spark):
    def made(*places):
        box = make_box(*map(F.lit, (0, 0, 9, 9)))
        return F.array(*[objects.make_object(F.lit(p).cast("int"), F.lit(f"o{p}"), F.lit("t"), box, F.lit("d")) for p in places])

    rows = spark.createDataFrame([("s", "i", "u", "cctv", 9, 9)], "sample_id string, image_id string, image_uri string, source_type string, width int, height int")
    base = samples.base_samples(rows, RUN)

    def parts(*places):
        return [(r.part_no, r.n_parts, len(r.objects)) for r in objects.split_parts(base.withColumn("objects", made(*places)), 10).collect()]

    assert parts(0, 9) == [(0, 1, 2)] and parts(9, 10) == [(0, 2, 1), (1, 2, 1)] and parts(12) == [(1, 1, 1)]
    assert parts(-1) == [(-1, 1, 1)] and parts(3, None) == [(0, 2, 1), (None, 2, 0)]


def test_labels_are_read_in_one_pass(spark):
    replies = [
        {"hard_hat": True, "smoking": False, "notes": {"hard_hat": "", "smoking": 7, "other": "x"}},
        {"hard_hat": "true", "fighting": True, "notes": "none"},
        {"error": "", "sleeping_on_duty": False, "notes": None},
        {"error": "e", "hard_hat": True},
    ]
    rows = spark.createDataFrame([(n, json.dumps(r)) for n, r in enumerate(replies)], "n int, text string")
    read = rows.select("n", classify.labels_from_answers(F.try_parse_json("text")).alias("labels"))
    assert "element_at" not in logical(read)
    found = {r.n: [tuple(v) for v in r.labels] for r in read.collect()}
    said = "vlm classification"
    assert found == {
        0: [("helmet", "wearing_helmet", None, said), ("smoking", "not_smoking", None, "7")],
        1: [("fighting", "fighting", None, said)],
        2: [("sleeping", "not_sleeping", None, said)],
        3: [],
    }
