"""Detector replies to objects. Everything happens inside the reply's own row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import vocab
from boxloom.functions.columns import (
    bind,
    let,
    lookup,
    nonblank,
    null,
    number,
    positive_or,
    read,
    text_of,
    truthy,
)
from boxloom.functions.geometry import convert_value
from boxloom.operators.objects import OBJECTS, PART_SIZE, generated_id, make_object, object_id, split_parts
from boxloom.params import BoxService, RectangleService

_RESULT = "struct<id:variant,type:string,score:variant,value:variant>"
_TASK = f"struct<predictions:array<struct<score:variant,result:array<{_RESULT}>>>>"
_CORNERS = ("x1", "y1", "x2", "y2")
_RECT = ("x", "y", "width", "height")
_VALUE = "struct<" + ",".join(f"{name}:variant" for name in _CORNERS + _RECT) + ",rectanglelabels:array<string>>"


def _given_or(variant: Column, otherwise: Column) -> Column:
    """Number of a key that is present, null included; `otherwise` only when the key is absent."""
    return F.when(variant.isNotNull(), number(variant)).otherwise(otherwise)


def rectangle_results(payload: Column) -> Column:
    """Rectangle results of a labeling-tool payload, in document order.

    array<struct<id, score, value variant, prediction_score double>>; the payload is one task or a list
    of them. One typed read takes the payload apart; whatever has another shape is null in it.
    """
    tasks = F.coalesce(
        F.try_variant_get(payload, "$", f"array<{_TASK}>"), F.array(F.try_variant_get(payload, "$", _TASK))
    )

    def of_prediction(prediction: Column) -> Column:
        rectangles = F.filter(prediction["result"], lambda r: F.coalesce(r["type"] == "rectanglelabels", F.lit(False)))
        score = number(prediction["score"])
        return F.transform(
            rectangles,
            lambda r: F.struct(
                r["id"].alias("id"),
                r["score"].alias("score"),
                r["value"].alias("value"),
                score.alias("prediction_score"),
            ),
        )

    def of_task(task: Column) -> Column:
        return F.flatten(F.filter(F.transform(task["predictions"], of_prediction), lambda found: found.isNotNull()))

    return F.flatten(F.filter(F.transform(tasks, of_task), lambda found: found.isNotNull()))


def _read_rectangle(entry: Column, service: RectangleService) -> Column:
    def fields(value: Column) -> Column:
        def present(names: tuple[str, ...]) -> Column:
            found = value[names[0]].isNotNull()
            for name in names[1:]:
                found = found & value[name].isNotNull()
            return F.coalesce(found, F.lit(False))

        return F.struct(
            entry["value"].alias("value"),
            F.coalesce(F.get(value["rectanglelabels"], F.lit(0)), F.lit(service.target_label)).alias("label"),
            entry["id"].alias("source_id"),
            text_of(entry["id"]).alias("source_text"),
            _given_or(entry["score"], entry["prediction_score"]).alias("confidence"),
            present(_CORNERS).alias("has_corners"),
            present(_RECT).alias("has_rect"),
            *[number(value[name]).alias(name) for name in _CORNERS + _RECT],
        )

    return let(F.try_variant_get(entry["value"], "$", _VALUE), fields)


def rectangle_objects(
    payload: Column,
    image_uri: Column,
    width: Column,
    height: Column,
    service: RectangleService,
    request_width: Column,
    request_height: Column,
) -> Column:
    """Objects of a labeling-tool payload.

    struct<objects, n_bad>: results whose box cannot be read are left out and counted in `n_bad`.
    Ordinals, and with them generated ids, count the accepted objects of the whole payload.
    """

    def with_box(read_out: Column) -> Column:
        def fields(*names: str) -> tuple[Column, ...]:
            return tuple(read_out.getField(name) for name in names)

        converted = convert_value(
            fields("x1", "y1", "x2", "y2"),
            fields("x", "y", "width", "height"),
            read_out.getField("has_corners"),
            read_out.getField("has_rect"),
            width,
            height,
            request_width,
            request_height,
            service.coordinate_units,
            service.auto_detect_units,
        )
        return F.struct(read_out.alias("read"), converted.alias("converted"))

    def name(entry: Column, i: Column) -> Column:
        """The identifier, worked out once for its two places in the object."""
        return F.struct(
            entry.getField("read").alias("read"),
            entry.getField("converted").alias("converted"),
            object_id(entry.getField("read").getField("source_text"), service.object_id_prefix, i + 1).alias("identifier"),
        )

    def build(entry: Column, i: Column) -> Column:
        found, converted = entry.getField("read"), entry.getField("converted")
        label, source_id = found.getField("label"), found.getField("source_id")
        mapped = F.coalesce(lookup(service.object_type_map, label), F.lit(service.default_object_type))
        provenance = F.to_variant_object(
            F.struct(
                F.lit(vocab.DETECTOR_BACKEND).alias("detector_backend"),
                F.lit(vocab.OBJECT_CONTRACT).alias("output_contract"),
                F.lit(vocab.RECTANGLE_SOURCE_FORMAT).alias("source_format"),
                converted.getField("unit").alias("coordinate_unit"),
                F.lit(service.prompt_version).cast("string").alias("prompt_version"),
                label.alias("target_label"),
                source_id.alias("source_result_id"),
                found.getField("value").alias("labelstudio_percent_box"),
                converted.getField("box").alias("converted_xyxy_box"),
                width.alias("image_width"),
                height.alias("image_height"),
                positive_or(request_width, width).alias("request_image_width"),
                positive_or(request_height, height).alias("request_image_height"),
                image_uri.alias("source_image_uri"),
                (payload if service.store_raw_response else null("variant")).alias("raw_response"),
            )
        )
        return make_object(
            i,
            entry.getField("identifier"),
            mapped,
            converted.getField("box"),
            F.lit(service.geometry_source),
            service.model_name,
            service.model_version,
            found.getField("confidence"),
            generation_params=provenance,
        )

    def assemble(entries: Column) -> Column:
        good = F.filter(entries, lambda e: e.getField("converted").isNotNull())
        return let(
            good,
            lambda kept: F.struct(
                F.transform(F.transform(kept, name), build).alias("objects"), (F.size(entries) - F.size(kept)).alias("n_bad")
            ),
        )

    read_out = F.transform(rectangle_results(payload), lambda e: _read_rectangle(e, service))
    return let(F.transform(read_out, with_box), assemble)


def coerce_box(raw: Column) -> Column:
    """Box from {x1, y1, x2, y2} or a list of four, truncated to integers; null for any other shape."""
    listed = F.try_variant_get(raw, "$", "array<int>")
    named = F.try_variant_get(raw, "$", "struct<x1:int,y1:int,x2:int,y2:int>")

    def shape(found: Column) -> Column:
        def corner(i: int) -> Column:
            return F.coalesce(F.get(found["listed"], F.lit(i)), found["named"][_CORNERS[i]])

        whole = F.coalesce(F.size(found["listed"]), F.lit(4)) == 4
        for i in range(4):
            whole = whole & corner(i).isNotNull()
        box = F.struct(F.lit("xyxy").alias("format"), *[corner(i).alias(name) for i, name in enumerate(_CORNERS)])
        return F.when(whole, box)

    return let(F.struct(listed.alias("listed"), named.alias("named")), shape)


def _truthy_or(first: Column, second: Column) -> Column:
    return F.when(truthy(first), first).otherwise(second)


def listed_objects(payload: Column, service: BoxService) -> Column:
    """Objects of a boxes/objects payload: struct<objects, n_bad>.

    Ordinals are list positions, so an unreadable entry still takes its number.
    """
    field = service.objects_field if service.response_format == "objects" else service.boxes_field
    members = {
        service.label_field: "string",
        service.confidence_field: "double",
        service.bbox_field: "variant",
        "box": "variant",
        "confidence": "variant",
        "object_type": "string",
        "object_id": "string",
        "polygon": "array<array<double>>",
        "mask_uri": "string",
        "mask_format": "string",
    }
    shape = ",".join(f"`{name}`:{kind}" for name, kind in members.items())
    entries = read(payload, f"array<struct<{shape}>>", field)

    def build(entry: Column, i: Column) -> Column:
        label = entry[service.label_field]
        object_type = F.coalesce(
            nonblank(entry["object_type"]),
            nonblank(F.coalesce(lookup(service.object_type_map, label), label)),
            F.lit(service.default_object_type),
        )
        score = entry[service.confidence_field].cast("double")
        return make_object(
            i,
            F.coalesce(nonblank(entry["object_id"]), generated_id("obj", i + 1)),
            object_type,
            coerce_box(_truthy_or(entry["box"], entry[service.bbox_field])),
            F.lit(service.geometry_source),
            service.model_name,
            service.model_version,
            _given_or(entry["confidence"], score),
            polygon=entry["polygon"],
            mask_uri=entry["mask_uri"],
            mask_format=entry["mask_format"],
        )

    def assemble(built: Column) -> Column:
        return let(
            F.filter(built, lambda o: o["box"].isNotNull()),
            lambda kept: F.struct(kept.alias("objects"), (F.size(built) - F.size(kept)).alias("n_bad")),
        )

    return let(F.transform(F.coalesce(entries, F.array().cast(f"array<struct<{shape}>>")), build), assemble)


def detected_objects(services: dict[str, RectangleService | BoxService]) -> Column:
    """struct<objects, n_bad> from columns task_key, payload, image_asset, request_width/height.

    Each service's rule is one branch, so a row is read once however many services are configured.
    """
    size = (F.col("image_asset.width"), F.col("image_asset.height"))
    branches = None
    for key, service in services.items():
        if isinstance(service, RectangleService):
            found = rectangle_objects(
                F.col("payload"),
                F.col("image_asset.image_uri"),
                *size,
                service,
                F.col("request_width"),
                F.col("request_height"),
            )
        else:
            found = listed_objects(F.col("payload"), service)
        matches = F.col("task_key") == key
        branches = F.when(matches, found) if branches is None else branches.when(matches, found)
    empty = F.struct(F.array().cast(OBJECTS).alias("objects"), F.lit(0).alias("n_bad"))
    return F.coalesce(branches, empty) if branches is not None else empty


def detect(
    samples: DataFrame,
    payloads: DataFrame,
    services: dict[str, RectangleService | BoxService],
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Fill `objects` of samples (with task_key) from payloads (sample_id, payload, request sizes).

    A left join: an image without a reply keeps an empty list. `n_bad` counts unreadable results. Rows come
    out in parts (see `split_parts`).
    """
    joined = samples.drop("objects").join(
        payloads.select("sample_id", "payload", "request_width", "request_height"), "sample_id", "left"
    )
    found = bind(joined, {"_found": detected_objects(services)}, drop=("payload", "request_width", "request_height"))
    filled = (
        found.withColumn("objects", F.coalesce("_found.objects", F.array().cast(OBJECTS)))
        .withColumn("n_bad", F.coalesce("_found.n_bad", F.lit(0)))
        .drop("_found")
    )
    return split_parts(filled, part_size)
