"""JSON documents: writing them, reading them back, and taking arrays apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: ISO text with microseconds, so no timestamp loses precision on its way through a document.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def to_document(columns: Sequence[str | Column]) -> Column:
    """The columns as one JSON object, timestamps as ISO text at any nesting depth."""
    options = {"timestampFormat": ISO_MICROS, "timestampNTZFormat": ISO_MICROS}
    return F.to_json(F.struct(*columns), options)


def parse_document(doc: str | Column, schema: T.StructType | str, strict: bool = True) -> Column:
    """Parse once; pick fields from the result instead of re-reading the text per field.

    Strict, a text that is no document of this schema fails the job; otherwise what cannot be read is null.
    """
    return F.from_json(doc, schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def sub_document(doc: str | Column, path: str) -> Column:
    """A nested object as JSON text, including fields no schema names."""
    return F.get_json_object(doc, path)


def array_length(array: Column) -> Column:
    """Number of items; a missing or null array counts 0."""
    return F.when(array.isNull(), F.lit(0)).otherwise(F.size(array))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def iso_timestamp(text: Column, strict: bool = True) -> Column:
    """ISO text to a zone-less timestamp; an offset in the text is dropped, not applied."""
    return text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")
