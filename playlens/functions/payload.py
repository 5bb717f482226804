"""Fields of the JSON payload carried by play events, as native expressions.

A payload that is not JSON, or lacks ``item_name``, yields null instead of
failing the job; such rows drop out at the next join and are listed by
``playlens.operators.rejects``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlens.functions._util import as_col, ColumnOrName

# fixed values: event names of the device log
DEVICE_FIRST_TIME_CONNECTED = "DEVICE_FIRST_TIME_CONNECTED"
ITEM_PLAY_STARTED = "ITEM_PLAY_STARTED"
ITEM_PLAY_FINISHED = "ITEM_PLAY_FINISHED"


_FIELDS = "item_name STRING, did_reach_end_of_stream STRING, not_json STRING"


def payload_fields(payload: ColumnOrName) -> Column:
    """Struct ``item_name, did_reach_end_of_stream, not_json`` (text) of a payload.

    The one reader of payloads. Of repeated keys the last counts. What is no JSON object
    gives a null struct, or one with only ``not_json`` (the payload) set; text after
    the object makes it no JSON."""
    p = as_col(payload)
    parsed = F.from_json(p, _FIELDS, {"columnNameOfCorruptRecord": "not_json", "allowSingleQuotes": "false",
                                      "allowNonNumericNumbers": "true"})
    return F.when(F.rtrim(p).endswith("}"), parsed)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once per row, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), 0)


def _loose_value(p: Column, key: str) -> Column:
    """Text after ``key`` in a payload that need not be JSON: quotes of either kind or none, ``:`` or
    ``=``, a missing end. Null where the key or its value is missing."""
    before, sep = r"""(?:^|[{,;\s"'])""", r"""["']?\s*[:=]\s*"""

    def found(value: str) -> Column:
        return _once(F.trim(F.regexp_extract(p, before + key + sep + value, 1)), lambda v: F.when(v != "", v))

    # a text without a quote is not searched for values in such quotes, one without the key for none
    return F.when(p.contains(key), F.coalesce(
        F.when(p.contains('"'), found(r'"([^"]*)')), F.when(p.contains("'"), found("'([^']*)")),
        found(r"""([^,;}"'\s][^,;}]*)""")))


def tolerant_fields(payload: ColumnOrName) -> Column:
    """``payload_fields`` that also reads payloads which are no strict JSON (single quotes, no quotes,
    text cut off after the name, trailing commas). Where JSON reading gives a name it counts; else
    the keys are looked for in the text. ``not_json`` is set only where no name is found.

    The payload and its fields are computed once per row. Only a text that can hold the name as a JSON key
    (as it stands, or with an escape) is read as JSON: each one that is no JSON costs exceptions."""
    none = F.lit(None).cast("string")

    def named(strict: Column) -> Column:
        return F.struct(strict["item_name"].alias("item_name"),
                        strict["did_reach_end_of_stream"].alias("did_reach_end_of_stream"), none.alias("not_json"))

    def loose(p: Column) -> Column:
        return _once(_loose_value(p, "item_name"), lambda name: F.struct(
            name.alias("item_name"), _loose_value(p, "did_reach_end_of_stream").alias("did_reach_end_of_stream"),
            F.when(name.isNull(), p).alias("not_json")))

    def fields(p: Column) -> Column:
        may_be_json = p.contains('"item_name"') | p.contains("\\")
        strict = F.when(may_be_json, payload_fields(p))
        return F.coalesce(_once(strict, lambda s: F.when(s["item_name"].isNotNull(), named(s))), loose(p))

    return _once(as_col(payload), fields)


#: Readers of payloads by name.
READERS = {"strict": payload_fields, "tolerant": tolerant_fields}


def split_item_name(payload: ColumnOrName, finished: bool = False) -> Column:
    """The text-splitting form: what stands after the second ``:`` (after the third in a finish event, whose
    end flag comes first) without its quotes and brace; the file extension stays. Null where
    there are fewer parts."""
    part = F.get(F.split(as_col(payload), ":", -1), 3 if finished else 2)
    return F.nullif(F.regexp_replace(part, r"""^\s*["']|["']?\s*}?\s*$""", ""), F.lit(""))


def raw_item_name(payload: ColumnOrName) -> Column:
    return payload_fields(payload)["item_name"]


def strip_extension(item: ColumnOrName) -> Column:
    """Text before the first dot: ``Dr. Seuss.mp3`` → ``Dr``."""
    return F.substring_index(as_col(item), ".", 1)


def item_name(payload: ColumnOrName) -> Column:
    """``item_name`` of the payload up to its first dot."""
    return strip_extension(raw_item_name(payload))


def end_of_stream(payload: ColumnOrName) -> Column:
    """True only when ``did_reach_end_of_stream`` reads ``true`` (JSON true or the
    string "true", surrounding blanks ignored); missing or anything else → false."""
    return reached_end(payload_fields(payload)["did_reach_end_of_stream"])


def reached_end(field: ColumnOrName) -> Column:
    """The flag's text as a boolean."""
    return F.coalesce(F.trim(as_col(field)) == F.lit("true"), F.lit(False))


def to_timestamp_lenient(s: ColumnOrName) -> Column:
    """ISO text → TIMESTAMP; null instead of an error for unreadable text."""
    return as_col(s).try_cast("timestamp")
