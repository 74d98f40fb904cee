"""Value codecs: UTF-8 validation and the JSON envelope with or without schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.util import as_col


def decode_utf8(col) -> Column:
    """``bytes.decode('utf-8')``: NULL marks bytes that are not valid UTF-8.

    A plain cast would silently substitute U+FFFD.
    """
    return F.try_validate_utf8(as_col(col).cast("string"))


def encode_utf8(col) -> Column:
    return F.encode(as_col(col), "UTF-8")


def to_json_envelope(col, schemas: bool = True) -> Column:
    """JSON converter form of a string value.

    With schemas: ``{"schema":{"type":"string","optional":false},"payload":...}``;
    without: the bare JSON string.
    """
    v = as_col(col)
    if not schemas:
        # to_json needs a struct; strip the wrapper object around the value.
        wrapped = F.to_json(F.struct(v.alias("p")))
        return wrapped.substr(F.lit(6), F.length(wrapped) - F.lit(6))
    schema = F.struct(F.lit("string").alias("type"), F.lit(False).alias("optional"))
    return F.to_json(F.struct(schema.alias("schema"), v.alias("payload")))


def from_json_envelope(col, schemas: bool = True) -> Column:
    """Payload of a JSON envelope; NULL when the text is not one."""
    v = as_col(col)
    if not schemas:
        # one value: as the only element of an array
        one = F.from_json(F.concat(F.lit("["), v, F.lit("]")), "array<string>")
        return F.when(F.size(one) == 1, F.get(one, F.lit(0)))
    return F.from_json(v, "schema struct<type: string, optional: boolean>, payload string")["payload"]


# The converter's type names, as the types that a payload parsed
# from JSON may have.
_WHOLE_BITS = {"int8": 8, "int16": 16, "int32": 32, "int64": 64}
_FLOATS = ("float", "float32", "double", "float64")
# The converter's type of a Spark type.
_TYPE_OF = {"tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "float": "float",
            "double": "double", "boolean": "boolean", "string": "string"}


def typed_envelope(df, col: str, optional: bool = True) -> Column:
    """JSON converter form of a column with the schema of its own type
    (numbers, strings, booleans, and structs and arrays of them)."""
    from pyspark.sql import types as T

    def schema_of(kind, optional: bool, **more) -> dict:
        if isinstance(kind, T.StructType):
            fields = [schema_of(f.dataType, f.nullable, field=f.name) for f in kind.fields]
            return {"type": "struct", "optional": optional, "fields": fields, **more}
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "optional": optional, "items": schema_of(kind.elementType, kind.containsNull), **more}
        name = _TYPE_OF.get(kind.simpleString())
        if name is None:
            raise TypeError(f"{kind.simpleString()} has no JSON converter type")
        return {"type": name, "optional": optional, **more}

    import json
    head = json.dumps(schema_of(df.schema[col].dataType, optional), separators=(",", ":"))
    body = F.to_json(F.struct(F.col(col).alias("payload")), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"schema":' + head + ","), F.substring(body, F.lit(2), F.length(body)))


def parse_typed_envelope(col) -> Column:
    """A JSON envelope read by the schema that it carries: a struct ``(type,
    payload variant, valid)``.

    ``valid``: the text is an envelope and the payload is what its schema says -
    a whole number in the type's range, a number, a string, a boolean, or a
    struct whose required fields are there (fields of a struct are checked one
    level deep, elements of an array by kind) - or null where that is optional.
    Every record is judged by its own schema; what is not valid has no payload."""
    whole = F.try_parse_json(as_col(col))
    get = lambda path, kind: F.try_variant_get(whole, path, kind)
    kind = get("$.schema.type", "string")
    optional = F.coalesce(get("$.schema.optional", "boolean"), F.lit(False))
    payload = get("$.payload", "variant")
    fields = get("$.schema.fields", "array<struct<field: string, type: string, optional: boolean>>")
    absent = payload.isNull() | F.is_variant_null(payload)
    text = F.schema_of_variant(payload)

    def field_ok(f: Column) -> Column:
        value = F.get(F.map_values(F.map_filter(F.try_variant_get(payload, "$", "map<string, variant>"),
                                                lambda k, _: k == f["field"])), F.lit(0))
        none = value.isNull() | F.is_variant_null(value)
        return F.when(none, F.coalesce(f["optional"], F.lit(False))).otherwise(_is(value, F.schema_of_variant(value), f["type"]))

    good = (F.when(absent, optional & kind.isNotNull())
            .when(kind == "struct", F.startswith(text, F.lit("OBJECT")) & fields.isNotNull()
                  & F.forall(F.coalesce(fields, F.array().cast("array<struct<field: string, type: string, optional: boolean>>")),
                             field_ok))
            .when(kind == "array", F.startswith(text, F.lit("ARRAY")))
            .otherwise(_is(payload, text, kind)))
    valid = F.coalesce(whole.isNotNull() & good, F.lit(False))
    return F.struct(F.when(valid, kind).alias("type"), F.when(valid, payload).alias("payload"), valid.alias("valid"))


def _is(value: Column, text: Column, kind: Column) -> Column:
    """Whether a value that is not null has a plain converter type."""
    out = F.when(kind == "string", text == "STRING").when(kind == "boolean", text == "BOOLEAN")
    n = F.try_variant_get(value, "$", "bigint")
    for name, bits in _WHOLE_BITS.items():
        out = out.when(kind == name, (text == "BIGINT") & n.between(-2 ** (bits - 1), 2 ** (bits - 1) - 1))
    number = (text == "BIGINT") | (text == "DOUBLE") | F.startswith(text, F.lit("DECIMAL"))
    return out.when(kind.isin(list(_FLOATS)), number).otherwise(kind.isin("struct", "array"))
