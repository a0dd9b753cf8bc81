"""JSON helpers for the diagnosis column (``[{code, display}, ...]``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEM = "struct<code: string, display: string>"
# A JSON string that could be taken for an object once its quotes are gone: "{ or the same with an escaped brace.
_QUOTED_BRACE = r'"(\{|\\u007[bB])'


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def object_texts(col) -> Column:
    """The elements of a JSON array as JSON texts, NULL for elements that are no objects; NULL for text that is no JSON array.

    The text is parsed once, so the time is linear in its length. Strings come
    out without their quotes; where one could then look like an object, the
    types of the elements are read as well (a second parse of such texts only).
    """
    text = _c(col)
    items = F.from_json(text, "array<string>")
    types = F.transform(F.from_json(text, "array<variant>"), lambda v: F.schema_of_variant(v).startswith("OBJECT"))
    typed = F.when(types.isNull(), items).otherwise(F.zip_with(items, types, lambda item, is_object: F.when(is_object, item)))
    safe = F.when(text.rlike(_QUOTED_BRACE), typed).otherwise(items)
    return F.transform(safe, lambda item: F.when(item.startswith("{"), item))


def element_fields(item) -> Column:
    """``{code, display}`` of one element's JSON text, as ``->>`` gives them: numbers as text, objects as JSON text."""
    return F.from_json(_c(item), ITEM)


def diagnosis_elements(col) -> Column:
    """One ``{code, display}`` per element, its fields NULL for an element that is no object; NULL for text that is no JSON array."""
    none = F.struct(*[F.lit(None).cast("string").alias(name) for name in ("code", "display")])
    return F.transform(object_texts(col), lambda item: F.coalesce(element_fields(item), none))


def is_rejected(col) -> Column:
    """Text that is there but no JSON array (another JSON value, or malformed)."""
    text = _c(col)
    return text.isNotNull() & F.from_json(text, "array<string>").isNull()
