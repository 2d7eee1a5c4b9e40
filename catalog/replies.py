"""Text rules, JSON in replies, ordinals, ids and retries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import text
from boxloom.operators import objects, replies
from boxloom.operators.ranking import numbered
from catalog.inputs import Tables, with_inputs
from catalog.registry import query

SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def short(value: str, limit: int) -> str:
    return f"CASE WHEN length({value}) > {limit} THEN concat(rtrim(left({value}, {limit - 3})), '...') ELSE {value} END"


@query(
    "t6_preview",
    f"SELECT doc_id, {short('v', 300)} AS preview FROM (SELECT doc_id, trim(regexp_replace(text, '{SPACES}', ' ', 'g')) AS v FROM documents)",
)
def t6(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", text.preview(F.col("text")).alias("preview"))


@query(
    "t7_clean_note",
    f"""SELECT doc_id, {short('v', 180)} AS note FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(text,
    '[*_`#>-]+', ' ', 'g'), '{SPACES}', ' ', 'g'), ' :;,.') AS v FROM documents)""",
)
def t7(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", text.clean_note(F.col("text")).alias("note"))


@query(
    "t10_timestamps",
    """SELECT event_id, concat(strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S'), '+08:00') AS local_time,
    concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'Z') AS utc_time FROM events""",
)
def t10(t: Tables) -> DataFrame:
    return t.read("events").select(
        "event_id",
        text.iso_at_offset(F.col("ts")).alias("local_time"),
        text.iso_utc(F.col("ts")).alias("utc_time"),
    )


@query(
    "t13_xml_escape",
    "SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages",
)
def t13(t: Tables) -> DataFrame:
    return t.read("pages").select("page_id", text.xml_escape(F.col("html")).alias("escaped"))


@query("t14_control_name", "SELECT p_partkey, concat('cls_', p_type) AS control FROM part")
def t14(t: Tables) -> DataFrame:
    return t.read("part").select("p_partkey", text.control_name(F.col("p_type")).alias("control"))


# --- JSON inside replies ----------------------------------------------------------------------------

MIXED = """CASE event_id % 6 WHEN 0 THEN concat('list [1, ', event_id, '] then {"id": ', event_id, '} end')
  WHEN 1 THEN concat('{"id": ', event_id, ', "id": ', event_id + 1, '} [2]') WHEN 2 THEN concat('```json', chr(10), '[', event_id, ']', chr(10), '```')
  WHEN 3 THEN concat('{broken [ {"id": ', event_id, ', "s": "}]"}') WHEN 4 THEN concat('[{"id": ', event_id, '}, oops')
  ELSE concat('nothing here ', event_id) END"""


def expected(list_first: str, list_only: str) -> str:
    return f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN {list_first} WHEN 1 THEN concat('{{"id":', event_id + 1, '}}')
    WHEN 2 THEN {list_only} WHEN 3 THEN concat('{{"id":', event_id, ',"s":"}}]"}}')
    WHEN 4 THEN concat('{{"id":', event_id, '}}') END AS found FROM events"""


LIST, OBJECT, ONLY = (
    "concat('[1,', event_id, ']')",
    "concat('{\"id\":', event_id, '}')",
    "concat('[', event_id, ']')",
)


def found(t: Tables, rule) -> DataFrame:
    rows = t.derive("events", {"event_id": "event_id", "raw_text": MIXED})
    return rows.select("event_id", F.to_json(rule(F.col("raw_text"))).alias("found"))


@query("t2_first_json", expected(LIST, ONLY))
def t2(t: Tables) -> DataFrame:
    return found(t, text.first_json)


@query("t3_first_object_or_json", expected(OBJECT, ONLY))
def t3(t: Tables) -> DataFrame:
    return found(t, text.first_object_or_json)


@query("t4_first_object", expected(OBJECT, "NULL"))
def t4(t: Tables) -> DataFrame:
    return found(t, text.first_object)


@query(
    "t5_parse_outcome",
    with_inputs(
        """SELECT event_id, CASE WHEN event_type = 'error' THEN 'unparseable' ELSE 'ok' END AS parse_status,
        CASE WHEN event_type = 'error' THEN 'VLMJsonParseError' END AS error_class,
        CASE WHEN event_type = 'error' THEN concat('no json {here ', event_id) END AS error_preview,
        CASE WHEN event_type = 'view' THEN value > 20 WHEN event_type = 'purchase' THEN false
          WHEN event_type <> 'error' THEN true END AS contains_person FROM fx_responses""",
        "fx_responses",
    ),
)
def t5(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(t.responses, "detection")
    return parsed.select(
        "event_id",
        "parse_status",
        "error_class",
        "error_preview",
        F.try_variant_get("payload", "$.contains_person", "boolean").alias("contains_person"),
    )


# --- ordinals and ids -------------------------------------------------------------------------------

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def ordinal_detections(t: Tables) -> DataFrame:
    """Detections with their 1-based `pos` per sample, without a window over a whole sample."""
    from catalog.inputs import DETECTIONS

    lines = t.read("lineitem").select("l_orderkey", *LINE_ORDER, "l_returnflag")
    placed = numbered(lines, ["l_orderkey"], LINE_ORDER, "ordinal")
    others = {name: value for name, value in DETECTIONS.items() if name != "pos"}
    return placed.selectExpr("CAST(ordinal AS INT) AS pos", *[f"{v} AS {k}" for k, v in others.items()])


@query(
    "w1_ordinal_ids",
    with_inputs(
        "SELECT sample_id, pos, confidence, concat('person_', lpad(CAST(pos AS VARCHAR), 6, '0')) AS object_id FROM fx_detections",
        "fx_detections",
    ),
)
def w1(t: Tables) -> DataFrame:
    rows = ordinal_detections(t)
    return rows.select(
        "sample_id", "pos", "confidence", objects.generated_id("person", F.col("pos")).alias("object_id")
    )


SOURCE_ID = """CASE p_partkey % 8 WHEN 0 THEN '' WHEN 1 THEN ' id ' WHEN 2 THEN '自动生成的唯一ID' WHEN 3 THEN 'unique_id'
  WHEN 4 THEN 'auto_id' WHEN 5 THEN NULL WHEN 6 THEN concat(' p', p_partkey) ELSE 'ID' END"""


@query(
    "w2_placeholder_ids",
    f"""SELECT p_partkey, CASE WHEN trim(coalesce(s, '')) IN ('', 'id', '自动生成的唯一ID', 'unique_id', 'auto_id')
    THEN concat('obj_', CASE WHEN p_partkey < 1000000 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0')
      ELSE CAST(p_partkey AS VARCHAR) END) ELSE s END AS object_id
    FROM (SELECT p_partkey, {SOURCE_ID} AS s FROM part)""",
)
def w2(t: Tables) -> DataFrame:
    rows = t.derive("part", {"p_partkey": "p_partkey", "s": SOURCE_ID})
    return rows.select("p_partkey", objects.object_id(F.col("s"), "obj", F.col("p_partkey")).alias("object_id"))


# --- retries ----------------------------------------------------------------------------------------

# an attempt is readable unless the event is an error; every third user never answers readably
READABLE = "event_type <> 'error' AND user_no % 3 > 0"
RETRY = {
    "event_id": "event_id",
    "user_no": "user_id",
    "sample_id": "concat('sample_', user_id, '_', event_id % 50)",
    "attempt": "CAST(event_id % 5 + 1 AS INT)",
    "event_type": "event_type",
    "raw_text": "CASE WHEN event_type <> 'error' AND user_id % 3 > 0 THEN concat('ok {\"n\": ', event_id, '}') ELSE 'busy {' END",
}
RETRY_SQL = f"SELECT {', '.join(f'{v} AS {k}' for k, v in RETRY.items())} FROM events"


@query(
    "w4_first_readable",
    f"""SELECT sample_id, count(*) FILTER (attempt <= 3) AS n_attempts,
    arg_min(event_id, attempt * CAST(1000000000 AS BIGINT) + event_id) FILTER ({READABLE} AND attempt <= 3) AS n
    FROM ({RETRY_SQL}) GROUP BY sample_id""",
)
def w4(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(t.derive("events", RETRY), "detection")
    best = replies.first_parseable(parsed, ["sample_id"], 3, tie_break=["event_id"])
    return best.select("sample_id", "n_attempts", F.try_variant_get("payload", "$.n", "bigint").alias("n"))


@query(
    "w4_chosen_attempt",
    f"""SELECT sample_id, min(attempt) FILTER (ok AND attempt <= 3) AS attempt FROM (SELECT sample_id, attempt,
    bool_and({READABLE}) AS ok FROM ({RETRY_SQL}) GROUP BY sample_id, attempt) GROUP BY sample_id""",
)
def w4_chosen(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(t.derive("events", RETRY), "review")
    stage = parsed.select("sample_id", "attempt", "event_type", (F.col("parse_status") == "ok").alias("ok"))
    views, others = stage.filter("event_type = 'view'"), stage.filter("event_type <> 'view'")
    return replies.choose_attempts([views, others], 3, first_needed=False).select("sample_id", "attempt")
