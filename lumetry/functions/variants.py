"""Messages as VARIANT: parsed once, whatever they hold, and read field by field after that.

A schema given to `from_json` sees a message that does not fit as a row of NULLs. A variant still knows what was sent, so
objects, arrays, arrays without elements and fields of another type are told apart without a second look at the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a variant may hold for a field of a type. A number that does not fit is NULL all the same.
WHOLE, NUMBER = ("BIGINT",), ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
ACCEPTED = {"int": WHOLE, "bigint": WHOLE, "float": NUMBER, "double": NUMBER}
STATUSES = ("ok", "empty", "malformed", "no_elements", "no_object", "bad_fields")


def as_variants(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`value`, the text of each message, and `content`, a VARIANT; NULL where the text is no JSON.

    Both pass through `inline`, as with `parse`, so that no filter on the content has a message parsed again.
    """
    text = F.col("value").cast("string")
    return messages.select(*keep, F.inline(F.array(F.struct(text.alias("value"), F.try_parse_json(text).alias("content")))))


def variant_elements(variants: DataFrame) -> DataFrame:
    """One row per element of messages that hold an array, and one for every other message, empty arrays included.

    `value` is the element as JSON where there was an array, and `whole` says that the row is a message by itself. The JSON
    is written only where `value` is used.
    """
    rows, element = _parted(variants)
    others = [c for c in variants.columns if c not in ("value", "content")]
    whole = F.col(element).isNull()
    text = F.when(whole, F.col("value")).otherwise(F.to_json(element))
    return rows.select(*others, text.alias("value"), "content", whole.alias("whole"))


def _parted(variants: DataFrame) -> tuple[DataFrame, str]:
    """The rows of `variant_elements`, each with its own content and the text of its message, and the name of a column that
    is NULL where a row is a message by itself."""
    element = f"{max(variants.columns, key=len)}_element"
    others = [c for c in variants.columns if c not in ("value", "content")]
    # An element that is null is a variant, too: without one there was no array, or an empty one.
    each = F.explode_outer(F.try_variant_get("content", "$", "array<variant>")).alias(element)
    rows = variants.select(*others, "value", "content", each)
    return rows.withColumn("content", F.coalesce(element, "content")), element


def _path(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']"


def variant_field(content: Column | str, name: str, kind: str) -> Column:
    """A field as a column; NULL where it is missing, null or of another type."""
    value = F.try_variant_get(content, _path(name), kind)
    if kind not in ACCEPTED:
        return value
    sent = F.schema_of_variant(F.try_variant_get(content, _path(name), "variant"))
    return F.when(F.substring(sent, 1, len("DECIMAL")).isin(*ACCEPTED[kind]), value)


def variant_fields(schema: str) -> list[Column]:
    """The fields of a schema, from the column `content`."""
    return [variant_field("content", f.name, f.dataType.simpleString()).alias(f.name) for f in T.StructType.fromDDL(schema)]


def variant_status(schema: str, read: Sequence[str] | None = None) -> Column:
    """What is wrong with `value` and its `content`: `empty` (no text), `malformed` (no JSON), `no_elements` (an array without
    any), `no_object` (a number, a text or an array), `bad_fields` (some field of the schema has another type), or `ok`.

    `read`: columns that hold the fields already; the content is then looked at only where one is NULL.
    """
    bad, none = F.lit(False), F.lit(True)
    for f, field in zip(T.StructType.fromDDL(schema), read or variant_fields(schema), strict=True):
        field = F.col(f"`{field}`") if read else field
        sent = F.try_variant_get("content", _path(f.name), "variant")
        bad = bad | (field.isNull() & sent.isNotNull() & ~F.is_variant_null(sent))
        none = none & field.isNull()
    # What has a field is an object, and what has a content has a text, which need not be written to know that.
    kind = F.when(none, F.schema_of_variant("content")).otherwise("OBJECT")
    missing = F.col("content").isNull()
    return (
        F.when(missing & (F.col("value").isNull() | (F.trim("value") == "")), "empty")
        .when(missing, "malformed")
        .when(kind == "ARRAY<VOID>", "no_elements")
        .when(~kind.startswith("OBJECT"), "no_object")
        .when(F.coalesce(bad, F.lit(False)), "bad_fields")
        .otherwise("ok")
    )


def variant_readings(variants: DataFrame, schema: str, elements: bool = False) -> DataFrame:
    """`value`, `status` and the fields of every row of `as_variants` or `variant_elements`. No message disappears.

    They pass through `inline`, so a filter on the status or a field does not have them looked up again, and the status is
    told from the fields as they were read. With `elements`, rows of `as_variants` are first parted into their elements, and
    JSON is written for `value` only after that, where a filter left the row: for elements, and messages landed without text.
    """
    others = [c for c in variants.columns if c not in ("value", "content", "whole")]
    names = [f.name for f in T.StructType.fromDDL(schema)]
    prefix = max(variants.columns, key=len)
    read, status = [f"{prefix}_{i}" for i in range(len(names))], f"{prefix}_status"
    text, used = F.col("value"), [*others, "value", "content"]
    if elements:
        variants, element = _parted(variants)
        text, used = F.coalesce(F.when(F.col(element).isNull(), text), F.to_json("content")), [*used, element]
    fields = F.struct(*(field.alias(name) for field, name in zip(variant_fields(schema), read)))
    rows = variants.select(*used, F.inline(F.array(fields)))
    rows = rows.select(*used, *read, F.explode(F.array(variant_status(schema, read))).alias(status))
    shown = [F.col(f"`{name}`").alias(as_) for name, as_ in zip(read, names)]
    return rows.select(*others, text.alias("value"), F.col(f"`{status}`").alias("status"), *shown)
