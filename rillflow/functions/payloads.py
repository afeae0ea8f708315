"""JSON payloads: reading, merging and writing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow import schemas
from rillflow.functions import times

KEEP_NULLS = {"ignoreNullFields": "false"}
CORRUPT = "_corrupt_record"
JSON_SPACE = " \t\r\n"


def has_field(document: Column, name: str) -> Column:
    """True when a parsed document is an object with the field, even as JSON null."""
    return F.try_variant_get(document, f"$.{name}", "variant").isNotNull()


def int_field(document: Column, name: str) -> Column:
    """Integer value of a field of a parsed document.

    Numeric text and decimals are coerced, booleans count as 1 and 0, and anything
    without an integer value counts as 0.
    """
    direct = F.try_variant_get(document, f"$.{name}", "int")
    as_text = F.try_variant_get(document, f"$.{name}", "string")
    return F.coalesce(direct, as_text.try_cast("double").try_cast("int"), F.lit(0))


def object_row(columns: Iterable[Column]) -> Column:
    """JSON object with the given fields in order, nulls included."""
    return F.to_json(F.struct(*columns), KEEP_NULLS)


def json_row(record_type: str) -> Column:
    """JSON row of a known record type; event times are written to the millisecond."""
    return object_row(
        times.format_millis(F.col(name)).alias(name) if name == "date" else F.col(name)
        for name in schemas.JSON_ROW_FIELDS[record_type]
    )


def without_fields(value: Column, document: Column, names: Iterable[str]) -> Column:
    """JSON text of an object less the named fields, where ``value`` can't be used as it is.

    Null if the object has none of the fields and the text ends with it. ``document`` is
    ``value`` parsed. It is looked into only where the text holds one of the names, or an
    escape that could spell one.
    """
    names = list(names)
    possible, clash = F.contains(value, F.lit("\\")), F.lit(False)
    for name in names:
        possible = possible | F.contains(value, F.lit(name))
        clash = clash | has_field(document, name)
    fields = document.try_cast(T.MapType(T.StringType(), T.VariantType()))
    cleared = F.to_json(F.map_filter(fields, lambda name, _: ~name.isin(names)))
    return F.when((possible & clash) | ~spans(value), cleared)


def spans(value: Column) -> Column:
    """Whether one JSON object is all of the text; the parser stops after the first one.

    Sure if the only closing brace is the last character. Otherwise the text is put into an
    object before another field, which is found only if nothing stands between them.
    """
    framed = F.try_parse_json(F.concat(F.lit('{"x":'), value, F.lit(',"y":0}')))
    fields = framed.try_cast(T.MapType(T.StringType(), T.VariantType()))
    whole = F.size(F.map_keys(fields)) == 2
    return value.rlike(r"^[^}]*\}\s*$") | F.coalesce(
        value.rlike(r"\}\s*$") & whole & has_field(framed, "y"), F.lit(False)
    )


def opened(value: Column) -> Column:
    """JSON object text without its closing brace."""
    trimmed = F.rtrim(value, F.lit(JSON_SPACE))
    return F.rtrim(F.regexp_replace(trimmed, r"\}$", ""), F.lit(JSON_SPACE))


def close_with(opened_object: Column, fields: Column) -> Column:
    """Finish an opened, non-empty object with the fields of a struct, nulls included."""
    added = F.substring(F.to_json(fields, KEEP_NULLS), 2, 2**31 - 1)
    return F.concat(opened_object, F.lit(","), added)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


INTEGER = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?\s*$"


def _as_read(schema: T.StructType) -> T.StructType:
    """Integer fields as text, so that numeric text and decimals can be taken too."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.IntegralType) else f.dataType)
        for f in schema.fields
    ])


def _whole(text: Column, kind: T.DataType) -> Column:
    """Integer of a number or of numeric text; decimals lose their fraction."""
    small = F.when(text.rlike(INTEGER), F.trim(text).try_cast(kind))
    return F.coalesce(small, F.when(text.rlike(NUMBER), text.try_cast("double").try_cast(kind)))


def _unreadable(schema: T.StructType, record: str) -> Column:
    """Whether an integer field holds something that is no integer of its type."""
    bad = F.lit(False)
    for f in schema.fields:
        if isinstance(f.dataType, T.IntegralType):
            text = F.col(f"{record}.{f.name}")
            bad = bad | (text.isNotNull() & _whole(text, f.dataType).isNull())
    return bad


def _typed(schema: T.StructType, record: str, zero_missing: bool) -> list[Column]:
    out = []
    for f in schema.fields:
        column = F.col(f"{record}.{f.name}")
        if isinstance(f.dataType, T.IntegralType):
            column = _whole(column, f.dataType)
            if zero_missing:
                column = F.coalesce(column, F.lit(0).cast(f.dataType))
        out.append(column.alias(f.name))
    return out


def _parsed(value: str, schema: T.StructType, options: dict[str, str]) -> Column:
    """JSON text as one record per row, parsed once.

    A filter on the record would move below a plain column and parse the text anew for
    every field it looks at; it stays above an exploded one.
    """
    return F.explode(F.array(F.from_json(value, schema, options)))


def decode(
    rows: DataFrame,
    schema: T.StructType,
    keep: Iterable[str] = (),
    zero_missing: bool = True,
) -> DataFrame:
    """JSON text in ``value`` to columns; unknown fields are ignored.

    A malformed record, null or blank text, and a field that is no integer where one is
    asked for fail the job. Numeric text counts as its number, decimals lose their fraction.
    ``keep`` names columns of ``rows`` to carry
    along; a kept column wins over a payload field of the same name.
    """
    keep = list(keep)
    record = rows.select(
        *keep,
        "value",
        _parsed("value", _as_read(schema), {"mode": "FAILFAST"}).alias("_record"),
    )
    failure = F.raise_error(
        F.concat(F.lit("not a record: "), F.coalesce("value", F.lit("null")))
    ).cast("boolean")
    broken = F.col("_record").isNull() | _unreadable(schema, "_record")
    record = record.filter(F.when(broken, failure).otherwise(True)).select(*keep, "_record")
    return _record_columns(record, schema, keep, zero_missing)


def decode_or_divert(
    rows: DataFrame,
    schema: T.StructType,
    keep: Iterable[str] = (),
    zero_missing: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Like :func:`decode`, but returns (decoded rows, malformed source rows)."""
    keep = list(keep)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = rows.withColumn("_record", _parsed("value", _with_corrupt(_as_read(schema)), options))
    broken = (
        F.col("_record").isNull() | F.col(f"_record.{CORRUPT}").isNotNull()
        | _unreadable(schema, "_record")
    )
    good = parsed.filter(~broken).select(*keep, "_record")
    return (
        _record_columns(good, schema, keep, zero_missing),
        parsed.filter(broken).select(*rows.columns),
    )


def _record_columns(
    record: DataFrame, schema: T.StructType, keep: list[str], zero_missing: bool
) -> DataFrame:
    payload = T.StructType([f for f in schema.fields if f.name not in keep])
    return record.select(*_typed(payload, "_record", zero_missing), *keep)
