"""Payloads and header values: JSON, broker time, paths, text fields, report lines."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The message header's time format and the characters a correlation id may have.
BROKER_TIME = "yyyyMMdd'T'HHmmss.SSSSSSX"
BROKER_TIME_LENIENT = "yyyyMMdd'T'HHmmss[.SSSSSS][.SSS][X]"
CORRELATION_ID_PATTERN = "^[A-Za-z0-9+/=]*$"

_PATH = re.compile(r"(?<![\w/'\"])/([A-Za-z_]\w*(?:/[A-Za-z_]\w*)*)")
_QUOTED = re.compile(r"('(?:[^']|'')*')")
_MOD = re.compile(r"\bMOD\b", re.IGNORECASE)


def path_filter(text: str, root: str | None = None) -> Column:
    """A filter text with ``/a/b`` paths as a Spark predicate; Spark itself parses the rest.

    Quoted literals are left alone.  ``MOD`` becomes ``%`` and other names (``CRC32``, ``AND``)
    already mean the same in Spark SQL.
    """
    prefix = f"{root}." if root else ""

    def plain(part: str) -> str:
        return _MOD.sub("%", _PATH.sub(lambda m: prefix + m.group(1).replace("/", "."), part))

    return F.expr("".join(p if p.startswith("'") else plain(p) for p in _QUOTED.split(text)))


def parse_json(df: DataFrame, schema: T.StructType | str, source: str = "data",
               into: str = "payload") -> DataFrame:
    """Parse the payload once; a malformed text gives a null record and keeps its row."""
    return df.withColumn(into, F.from_json(source, schema))


def json_or_null(source: str, schema: T.StructType) -> Column:
    """The parsed record, or null when the text is not a JSON object of this shape."""
    checked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(source, checked)
    return F.when(parsed["_corrupt_record"].isNull(), F.struct(*[parsed[f.name].alias(f.name)
                                                               for f in schema.fields]))


def with_defaults(record: str, defaults: Mapping[str, object]) -> list[Column]:
    """Fields of ``record``, a missing one taking its default."""
    return [F.coalesce(F.col(f"{record}.{n}"), F.lit(v)).alias(n) for n, v in defaults.items()]


def to_json_text(*fields: Column | str) -> Column:
    """Record as JSON text; null fields are left out, which is what a partial record needs."""
    return F.to_json(F.struct(*fields))


def payload_length(data: str = "data") -> Column:
    """Payload length in bytes, null for a null payload."""
    return F.octet_length(F.col(data))


def parse_broker_time(text: Column | str) -> Column:
    """Header time text as a timestamp cut to milliseconds; null stays null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.date_trunc("MILLISECOND", F.to_timestamp(col, BROKER_TIME))


def broker_time_text(ts: Column | str) -> Column:
    """Timestamp as header time text (UTC session)."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss.SSSSSS'Z'")


#: Levels of objects and arrays up to which a payload is replaced in place.
NESTING = 4


def replace_json_field(data: Column | str, field: str, value: str) -> Column:
    """Replace the value of one field of a JSON object by a text.

    Only a field of the object itself is replaced, whatever its value; fields of that name further in
    stay.  The rest stays byte for byte, unless a value before the field is nested deeper than NESTING
    levels: then the object is parsed and written anew, with the same content.
    """
    literal = value.replace("\\", "\\\\\\\\").replace('"', '\\\\"').replace("$", "\\$")
    text = r'"(?:[^"\\]|\\.)*+"'
    inner = rf'(?:[^{{}}\[\]"]|{text})*+'
    for _ in range(NESTING):
        inner = rf'(?:[^{{}}\[\]"]|{text}|\{{{inner}\}}|\[{inner}\])*+'
    block = rf'\{{{inner}\}}|\[{inner}\]'
    one = rf'{text}\s*+:\s*+(?:{text}|{block}|[^,{{}}\[\]\s]++)\s*+,\s*+'
    pattern = rf'(?s)^(\s*+\{{\s*+(?:{one})*?"{re.escape(field)}"\s*+:\s*+)(?:{text}|{block}|[^,{{}}\[\]\s]++)'
    column = F.col(data) if isinstance(data, str) else data
    replaced = F.regexp_replace(column, pattern, f'$1"{literal}"')
    parsed = F.from_json(column, "map<string,variant>")
    new = F.parse_json(F.lit(json.dumps(value)))
    anew = F.to_json(F.transform_values(parsed, lambda k, v: F.when(k == F.lit(field), new).otherwise(v)))
    deep = ((replaced == column) & F.contains(column, F.lit(f'"{field}"'))
            & F.coalesce(F.map_contains_key(parsed, field), F.lit(False)) & ~column.rlike(pattern))
    return F.when(deep, anew).otherwise(replaced)


def first_part(data: Column | str, separator: str = ",") -> Column:
    """Text before the first separator."""
    return F.substring_index(data, separator, 1)


def valid_correlation_id(col: Column) -> Column:
    return col.rlike(CORRELATION_ID_PATTERN)
