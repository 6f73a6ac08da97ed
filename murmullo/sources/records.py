"""JSON records: decode, encode, quarantine and field merge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmullo.functions.coerce import safe_bool, safe_double, safe_int
from murmullo.functions.text import has_text


def _parsed(value: Column) -> Column:
    """The line as a variant if it is one JSON object, else null. What is valid JSON
    and begins with a brace is an object."""
    begins = F.ltrim(value, F.lit(" \t\n\r")).startswith("{")
    return F.when(begins, F.try_parse_json(value))


def good_records(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The well-formed records as text columns, each line parsed once.

    A record is one JSON object as the standard has it: ``NaN``, infinities and
    repeated keys make a line malformed, here and in the streams alike. A filter
    on the parsed line would parse it again, so the line becomes a list of one
    or no record, which is then unfolded.
    """
    record = F.filter(F.array(_parsed(F.col(value))), lambda r: r.isNotNull())
    rest = [c for c in df.columns if c != value]
    parsed = df.filter(has_text(F.col(value))).select(*rest, F.explode(record).alias("_record"))
    return parsed.select(*rest, *[
        F.try_variant_get("_record", f"$['{f.name}']", "string").alias(f.name)
        for f in schema.fields
    ])


def malformed_lines(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The lines that hold no record. Blank lines are left out."""
    return df.filter(has_text(F.col(value)) & _parsed(F.col(value)).isNull())


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as the types of ``schema``, bad values as defaults."""
    rules = {"bigint": safe_int, "int": safe_int, "double": safe_double, "boolean": safe_bool}
    return df.withColumns({
        f.name: rules[f.dataType.simpleString()](F.col(f.name)).cast(f.dataType)
        for f in schema.fields
        if f.dataType.simpleString() in rules
    })


def decode(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Good records with their declared types.

    Numbers are read as text first, because ``"7"`` and ``7.9`` are both valid
    input for a whole number.
    """
    return typed(good_records(df, schema, value), schema)


def encode(df: DataFrame, *columns: str, value: str = "value") -> DataFrame:
    """One JSON text per row, of the given columns or of all."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(value))


def parse_record(value: Column) -> Column:
    """A JSON object with all its fields, whatever they are; else null."""
    return F.try_variant_get(F.try_parse_json(value), "$", "map<string,variant>")


def text_field(record: Column, name: str) -> Column:
    """One field of a parsed record as a string; null where absent."""
    return F.try_variant_get(record[name], "$", "string")


def set_fields(record: Column, fields: Mapping[str, Column]) -> Column:
    """A parsed record with these fields set and every other one as it was."""
    names = list(fields)
    kept = F.map_filter(record, lambda key, _: ~key.isin(names))
    new = F.create_map(
        *[x for name, col in fields.items() for x in (F.lit(name), col.cast("variant"))]
    )
    return F.map_concat(kept, new)
