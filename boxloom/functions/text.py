"""Text rules: slugs, previews, notes, escapes, and finding JSON inside model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxloom.functions.columns import let, nonblank, null

# Everything Unicode counts as white space, for trimming and for collapsing runs.
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITE_RUN = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_RUN, " ")


def shorten(text: Column, limit: int) -> Column:
    """Cut to `limit` characters, the last three of them dots."""
    cut = F.concat(F.rtrim(F.left(text, F.lit(limit - 3)), F.lit(WHITE)), F.lit("..."))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def preview(text: Column, limit: int = 300) -> Column:
    return shorten(strip(collapse(F.coalesce(text, F.lit("")))), limit)


def clean_note(text: Column, limit: int = 180) -> Column:
    """Note text without markdown marks and edge punctuation.

    What a beginning of the text cleans to is the beginning of what the whole cleans to, so once that is over the
    limit the rest of a long text is not looked at.
    """

    def cleaned(part: Column) -> Column:
        return F.btrim(collapse(F.regexp_replace(part, "[*_`#>-]+", " ")), F.lit(" :;,."))

    def judge(head: Column) -> Column:
        whole = let(cleaned(text), lambda plain: shorten(plain, limit))
        return F.when((F.length(text) <= reach) | (F.length(head) > limit), shorten(head, limit)).otherwise(whole)

    reach = 2 * limit
    return let(cleaned(F.left(text, F.lit(reach))), judge)


def slugify(text: Column, fallback: str = "item") -> Column:
    slug = F.btrim(F.regexp_replace(text, "[^0-9A-Za-z_.-]+", "_"), F.lit("._-"))
    return F.coalesce(nonblank(slug), F.lit(fallback))


def forward_slashes(uri: Column) -> Column:
    return F.translate(uri, "\\", "/")


def xml_escape(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def control_name(label_key: Column) -> Column:
    return F.concat(F.lit("cls_"), label_key)


def iso_at_offset(moment: Column, zone: str = "+08:00") -> Column:
    """Timestamp (session zone UTC) as ISO text with seconds and a fixed offset."""
    local = F.from_utc_timestamp(moment, zone)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(zone))


def iso_utc(moment: Column) -> Column:
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def cut_before(text: Column, pattern: str) -> Column:
    """Pieces of the text, cut before every match of `pattern`.

    A marker is inserted and split on, which is faster than splitting by pattern; texts that happen to
    contain the marker are split by the pattern.
    """
    ahead, marker = f"(?={pattern})", "\ue000"
    marked = F.split(F.regexp_replace(text, ahead, marker), marker)
    return F.when(F.contains(text, F.lit(marker)), F.split(text, ahead)).otherwise(marked)


def _first_value(text: Column, openers: str) -> Column:
    """First position among `openers` from which a JSON value decodes; what follows it is ignored.

    The text is cut before every opener, so the candidate at piece i is the rest from i on. A reply
    that is JSON from its first opener, by far the usual case, needs a single parse.
    """
    opener_class = "[" + "".join("\\" + mark for mark in openers) + "]"
    marks = [F.lit(mark) for mark in openers]

    def scan(pieces: Column) -> Column:
        count = F.size(pieces)

        def attempt(found: Column, i: Column) -> Column:
            begins = F.left(F.get(pieces, i - 1), F.lit(1)).isin(*marks)
            rest = F.array_join(F.slice(pieces, i, count), "")
            return F.coalesce(found, F.when(begins, F.try_parse_json(rest)))

        return F.aggregate(F.sequence(F.lit(1), count), null("variant"), attempt)

    first_at = F.regexp_instr(text, F.lit(opener_class))
    whole = F.when(first_at > 0, F.try_parse_json(F.substring(text, first_at, F.length(text))))
    searched = F.when(first_at > 0, let(cut_before(text, opener_class), scan))
    return F.coalesce(whole, searched)


def first_json(text: Column) -> Column:
    """First decodable object or array (detector replies)."""
    return _first_value(text, "{[")


def first_object(text: Column) -> Column:
    """First decodable object (review replies)."""
    return _first_value(text, "{")


def first_object_or_json(text: Column) -> Column:
    """First decodable object, else the first decodable array (classifier replies)."""
    return F.coalesce(first_object(text), first_json(text))
