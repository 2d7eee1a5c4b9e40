"""Multi-label classification of crops from yes/no answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import schema, vocab
from boxloom.functions.columns import (
    bind,
    is_boolean,
    is_object,
    kind_of,
    let,
    members,
    nonblank,
    null,
    strings,
    truthy,
)
from boxloom.functions.geometry import box_height, box_width
from boxloom.functions.text import clean_note, cut_before, first_object_or_json
from boxloom.operators.boxes import crop_problem
from boxloom.operators.objects import PART_SIZE
from boxloom.operators.replies import align, at_position
from boxloom.operators.samples import advance
from boxloom.params import Classifier, Run

LABELS = "array<struct<label_key:string,label_value:string,confidence:double,evidence:string>>"
_MEMBERS = "map<string,variant>"
_KEY_GROUP = "(" + "|".join(vocab.ANSWER_KEYS) + ")"
# most places are ruled out by their letter, before anything is looked at around them
_INITIALS = "".join(sorted({key[0] for key in vocab.ANSWER_KEYS}))
_MENTION = rf"(?=[{_INITIALS}])(?<![a-z0-9_]){_KEY_GROUP}(?![a-z0-9_])"
_KEY_REACH = max(map(len, vocab.ANSWER_KEYS)) + 1


def _members(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", _MEMBERS)


def _no_members() -> Column:
    return F.create_map().cast(_MEMBERS)


def _notes_of(members: Column) -> Column:
    """The `notes` object as a map; empty when absent or not an object."""
    notes = F.try_element_at(members, F.lit("notes"))
    return F.coalesce(F.when(is_object(notes), _members(notes)), _no_members())


def _with_members(raw: Column, body: Callable[[Column], Column]) -> Column:
    return let(F.when(is_object(raw), _members(raw)), body)


def labels_from_answers(raw: Column) -> Column:
    """Labels for the answers that are true or false, in fixed key order.

    Texts such as "true" are not booleans. A reply with an error, or no object at all, has no labels.
    """

    def labels(found: Column) -> Column:
        def label(notes: Column, key: str, name: str, yes: str, no: str) -> Column:
            note, value = notes.getField("of").getField(key), found.getField(key)
            text = F.try_variant_get(note, "$", "string")
            # a note is nearly always a text, which is then read once
            evidence = F.when(kind_of(note) == "STRING", nonblank(text)).otherwise(F.when(truthy(note), text))
            made = F.struct(
                F.lit(name).alias("label_key"),
                F.when(F.try_variant_get(value, "$", "boolean"), F.lit(yes)).otherwise(F.lit(no)).alias("label_value"),
                null("double").alias("confidence"),
                F.coalesce(F.when(note.isNotNull(), evidence), F.lit(vocab.DEFAULT_EVIDENCE)).alias("evidence"),
            )
            return F.when(kind_of(value) == "BOOLEAN", made)

        notes = F.struct(members(found.getField("notes"), *vocab.ANSWER_KEYS).alias("of"))
        usable = found.isNotNull() & ~truthy(found.getField("error"))
        return F.when(usable, let(notes, lambda n: F.array_compact(F.array(*[label(n, *row) for row in vocab.BOOLEAN_LABELS]))))

    # one pass over the reply, where looking up a key in a map walks the keys before it
    return F.coalesce(let(members(raw, "error", "notes", *vocab.ANSWER_KEYS), labels), F.array().cast(LABELS))


def normalize_answers(raw: Column) -> Column:
    """Reply with all answer keys present as booleans; what was not boolean turns false with a note."""
    keys = strings(vocab.ANSWER_KEYS)

    def entry(key: Column, value: Column) -> Column:
        return F.struct(key.alias("key"), value.alias("value"))

    def constant(value) -> Column:
        return F.lit(value).cast("variant")

    def fill(members: Column) -> Column:
        def assemble(both: Column) -> Column:
            given, notes = both.getField("given"), both.getField("notes")
            present = F.map_keys(members)
            # few keys are left for the remarks, and none is looked at twice
            unsaid = F.array_except(F.array_except(keys, F.map_keys(given)), F.map_keys(notes))
            remarks = F.transform(
                unsaid,
                lambda key: entry(
                    key,
                    F.when(F.array_contains(present, key), constant(vocab.NOTE_NOT_BOOLEAN)).otherwise(constant(vocab.NOTE_MISSING_KEY)),
                ),
            )
            all_notes = F.to_variant_object(F.map_from_entries(F.concat(F.map_entries(notes), remarks)))
            answers = F.transform(keys, lambda key: entry(key, F.coalesce(F.try_element_at(given, key), constant(False))))
            extras = F.filter(F.map_entries(members), lambda e: ~e["key"].isin("notes", *vocab.ANSWER_KEYS))
            return F.to_variant_object(
                F.map_from_entries(F.concat(answers, F.array(entry(F.lit("notes"), all_notes)), extras))
            )

        # a cast to boolean also takes texts and numbers, so the kind decides; only the keys that are there are asked
        given = F.map_filter(members, lambda key, value: key.isin(*vocab.ANSWER_KEYS) & is_boolean(value))
        return let(F.struct(given.alias("given"), _notes_of(members).alias("notes")), assemble)

    def decide(reply: Column, members: Column) -> Column:
        failed = truthy(F.try_element_at(members, F.lit("error")))
        not_object = F.struct(F.lit(vocab.NOT_AN_OBJECT).alias("error"), reply.alias("raw"))
        return (
            F.when(members.isNull(), F.to_variant_object(not_object)).when(failed, reply).otherwise(fill(members))
        )

    def bound(reply: Column) -> Column:
        return F.when(reply.isNotNull(), _with_members(reply, lambda members: decide(reply, members)))

    return let(raw, bound)


def prose_answers(text: Column) -> Column:
    """Answers read from prose, as the JSON a strict model would have given; null without any.

    The text is cut before every whole-word mention of a key. A piece answers its key with the last
    true/false it contains; per key the first answering piece counts.
    """

    def named(piece: Column) -> Column:
        key = F.regexp_extract(F.left(piece, F.lit(_KEY_REACH)), rf"(?i)^{_KEY_GROUP}(?![a-z0-9_])", 1)
        return F.struct(F.lower(key).alias("key"), piece.alias("piece"))

    def piece_answer(found: Column) -> Column:
        words = F.regexp_extract_all(found["piece"], F.lit(r"(?=[tTfF])(?iU:\b(true|false)\b)"), 1)
        return F.struct(
            found["key"].alias("key"),
            F.lower(F.try_element_at(words, F.lit(-1))).alias("word"),
            found["piece"].alias("piece"),
        )

    def entry(key: Column, value: Column) -> Column:
        return F.struct(key.alias("key"), value.cast("variant").alias("value"))

    def build(found: Column) -> Column:
        keys = found["key"]
        firsts = F.filter(found, lambda f, i: F.array_position(keys, f["key"]) == i + 1)
        missing = F.array_except(strings(vocab.ANSWER_KEYS), keys)
        answers = F.concat(
            F.transform(firsts, lambda f: entry(f["key"], f["word"] == "true")),
            F.transform(missing, lambda key: entry(key, F.lit(False))),
        )
        said = F.transform(firsts, lambda f: F.struct(f["key"].alias("key"), clean_note(f["piece"]).alias("note")))
        notes = F.concat(
            F.array(entry(F.lit("_parser"), F.lit(vocab.PROSE_PARSER_TAG))),
            F.transform(F.filter(said, lambda n: n["note"] != ""), lambda n: entry(n["key"], n["note"])),
            F.transform(missing, lambda key: entry(key, F.lit(vocab.NOTE_NO_EXPLICIT_VALUE))),
        )
        extras = F.array(
            F.struct(F.lit("notes").alias("key"), F.to_variant_object(F.map_from_entries(notes)).alias("value")),
            entry(F.lit("_parse_mode"), F.lit(vocab.PROSE_MODE_TAG)),
            entry(F.lit("_raw_text_preview"), clean_note(text, 500)),
        )
        reply = F.to_variant_object(F.map_from_entries(F.concat(answers, extras)))
        return F.when(F.size(found) > 0, reply)

    # only pieces that begin with a key are searched for an answer
    pieces = F.filter(F.transform(cut_before(text, f"(?i:{_MENTION})"), named), lambda p: p.getField("key") != "")
    usable = F.filter(F.transform(pieces, piece_answer), lambda p: p.getField("word").isNotNull())
    return F.when(F.length(text) > 0, let(usable, build))


def read_answers(text: Column, text_fallback: bool = False) -> Column:
    """Normalized answers of a classifier reply: JSON first, prose if allowed, else null."""
    found = normalize_answers(first_object_or_json(text))
    if not text_fallback:
        return found
    # answers from prose have every key, and a note for each that needs one
    return F.coalesce(found, prose_answers(text))


def answers_readable(text: Column, text_fallback: bool = False) -> Column:
    """Whether `read_answers` finds anything, without building it.

    In prose some piece answers exactly when a true/false word follows the first mention of a key.
    """
    found = first_object_or_json(text).isNotNull()
    if text_fallback:
        found = found | F.coalesce(text.rlike(rf"(?is){_MENTION}.*?(?U:\b(true|false)\b)"), F.lit(False))
    return found


def classification_struct(raw: Column, classifier: Classifier) -> Column:
    """Classification record with labels and classifier provenance."""
    return F.struct(
        labels_from_answers(raw).alias("multi_labels"),
        F.lit(classifier.classifier_type).alias("classifier_type"),
        F.lit(classifier.classifier_name or classifier.model).cast("string").alias("classifier_name"),
        F.lit(classifier.classifier_version or classifier.model_version).cast("string").alias("classifier_version"),
        F.lit(classifier.prompt_version or vocab.DEFAULT_PROMPT_VERSION).alias("prompt_version"),
        raw.alias("raw_response"),
    )


def invalid_crop_answers(reason: Column, crop_uri: Column, width: Column, height: Column) -> Column:
    """What is stored as the reply of a crop that was not sent to the model."""
    return F.to_variant_object(
        F.struct(
            *[F.lit(False).alias(key) for key in vocab.ANSWER_KEYS],
            F.struct(*[reason.alias(key) for key in vocab.ANSWER_KEYS]).alias("notes"),
            F.lit(vocab.INVALID_CROP).alias("error"),
            crop_uri.alias("crop_uri"),
            width.alias("image_width"),
            height.alias("image_height"),
        )
    )


def crop_guard_check(reason: Column, now: str) -> Column:
    return F.struct(
        F.lit(True).alias("qc_sampled"),
        F.lit("failed").alias("qc_status"),
        null(schema.QUALITY_CHECK["reviewed_labels"].dataType).alias("reviewed_labels"),
        F.array(F.lit(vocab.INVALID_CROP)).alias("issue_flags"),
        F.lit(vocab.CROP_GUARD_REVIEWER).alias("reviewer"),
        F.lit(now).alias("review_time"),
        reason.alias("comment"),
    )


def is_skipped(skip_source_types: tuple[str, ...]) -> Column:
    """Samples left unclassified; an empty list means the generated ones."""
    return F.coalesce(F.col("image_asset.source_type").isin(*(skip_source_types or ("generated",))), F.lit(False))


def classify_with_answers(
    samples: DataFrame,
    answers: DataFrame,
    classifier: Classifier,
    skip_source_types: tuple[str, ...],
    run: Run,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Apply normalized answers (sample_id, pos, answers) to the objects of samples not skipped.

    Order of outcomes per object: no crop, unusable crop, answered. Objects without an answer row keep
    their classification.
    """
    joined = align(samples, answers, "answers", part_size)

    def outcome(obj: Column) -> Column:
        crop = obj.getField("crop")
        box = F.coalesce(crop.getField("crop_box"), obj.getField("box"))
        no_crop = nonblank(crop.getField("crop_uri")).isNull()
        problem = crop_problem(box, classifier.crop_guard)
        missing = F.to_variant_object(F.struct(F.lit(vocab.MISSING_CROP_URI).alias("error")))
        invalid = invalid_crop_answers(problem, crop.getField("crop_uri"), box_width(box), box_height(box))
        raw = (
            F.when(no_crop, missing)
            .when(problem.isNotNull(), invalid)
            .otherwise(at_position(F.col("answers"), obj))
        )
        return F.struct(obj.alias("obj"), F.when(~no_crop, problem).alias("problem"), raw.alias("raw"))

    def settle(entry: Column) -> Column:
        obj, problem, raw = entry.getField("obj"), entry.getField("problem"), entry.getField("raw")
        guarded = problem.isNotNull()
        return (
            obj.withField(
                "crop.is_valid_crop",
                F.when(guarded, F.lit(False)).otherwise(obj.getField("crop").getField("is_valid_crop")),
            )
            .withField(
                "quality_check",
                F.when(guarded, crop_guard_check(problem, run.now_utc)).otherwise(obj.getField("quality_check")),
            )
            .withField(
                "classification",
                F.when(raw.isNotNull(), classification_struct(raw, classifier)).otherwise(
                    obj.getField("classification")
                ),
            )
        )

    skipped = is_skipped(skip_source_types)
    settled = F.transform(F.transform("objects", outcome), settle)
    done = bind(joined, {"objects": F.when(skipped, F.col("objects")).otherwise(settled)}).drop("answers")
    return advance(done, "classified", run.now_utc, when=~skipped)


def classify_by_rule(
    samples: DataFrame,
    skip_source_types: tuple[str, ...],
    run: Run,
    labels: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """The same fixed labels on every object of the samples not skipped."""
    fixed = F.array(
        *[
            F.struct(
                F.lit(key).alias("label_key"),
                F.lit(value).alias("label_value"),
                null("double").alias("confidence"),
                F.lit(vocab.RULE_EVIDENCE).alias("evidence"),
            )
            for key, value in (vocab.RULE_LABELS if labels is None else labels)
        ]
    ).cast(LABELS)
    record = F.struct(
        fixed.alias("multi_labels"),
        F.lit("rule").alias("classifier_type"),
        F.lit(vocab.RULE_CLASSIFIER_NAME).alias("classifier_name"),
        F.lit(vocab.RULE_CLASSIFIER_VERSION).alias("classifier_version"),
        F.lit(vocab.RULE_PROMPT_VERSION).alias("prompt_version"),
        F.to_variant_object(
            F.struct(F.lit(True).alias("dry_run"), F.lit(vocab.RULE_REASON).alias("reason"))
        ).alias("raw_response"),
    )
    skipped = is_skipped(skip_source_types)
    labelled = F.transform("objects", lambda o: o.withField("classification", record))
    done = bind(samples, {"objects": F.when(skipped, F.col("objects")).otherwise(labelled)})
    return advance(done, "classified", run.now, when=~skipped)


def classify(
    samples: DataFrame,
    source: str,
    run: Run,
    answers: DataFrame | None = None,
    classifier: Classifier = Classifier(),
    skip_source_types: tuple[str, ...] = ("generated",),
    labels: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Classification by named source: model answers (`external_script`) or fixed labels (`dry_run_rule`)."""
    if source == "external_script":
        if answers is None:
            raise ValueError("external_script needs an answers table")
        return classify_with_answers(samples, answers, classifier, skip_source_types, run)
    if source == "dry_run_rule":
        return classify_by_rule(samples, skip_source_types, run, labels)
    raise ValueError(f"Unsupported classification source: {source}")
