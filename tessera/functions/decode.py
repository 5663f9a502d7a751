"""Tagged attribute decoding (PRJ-02) as a generated Spark expression.

An image is a map from attribute name to a one-key object naming the type:
``{"S": "x"}``, ``{"N": "25"}``, ``{"BOOL": true}``, ``{"NULL": true}``,
``{"L": [...]}``, ``{"M": {...}}``, ``{"SS": [...]}``, ``{"NS": [...]}``,
``{"BS": [...]}``.  Images arrive as ``variant`` values.  We walk the target
``StructType`` and emit ``try_variant_get`` / ``try_cast`` / ``transform``
expressions, so decoding runs inside whole-stage codegen with no Python.

Tag precedence follows the source rules: S, N, BOOL, NULL, L, M, SS, NS, BS.
A number with a "." is fractional, otherwise integral.  An unparseable number
decodes to null and its text is kept by :func:`raw_numbers`; only an
unparseable element of a number set makes the record fail (:func:`bad_sets`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, ByteType, DataType, DecimalType,
    DoubleType, FloatType, IntegerType, LongType, MapType, ShortType,
    StringType, StructType, VariantType,
)

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_FRACTIONAL = (FloatType, DoubleType, DecimalType)


def _path(name: str) -> str:
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"$['{escaped}']"


def _get(v: Column, path: str, type_str: str) -> Column:
    return F.try_variant_get(v, path, type_str)


def attr(image: Column, name: str) -> Column:
    """The tagged value of one attribute (still a variant)."""
    return _get(image, _path(name), "variant")


def _number(text: Column, dtype: DataType) -> Column:
    if isinstance(dtype, _INTEGRAL):
        # "25" -> 25; a "." marks a fractional literal; "1E5" is text
        return F.when(text.contains("."), text.try_cast("double").try_cast("bigint")) \
            .otherwise(text.try_cast("bigint")).cast(dtype)
    if isinstance(dtype, _FRACTIONAL):
        return text.try_cast(dtype)
    if isinstance(dtype, StringType):
        return text
    return F.lit(None).cast(dtype)


def decode_value(v: Column, dtype: DataType, path: str = "$") -> Column:
    """Decode the tagged value at ``path`` of variant ``v`` into ``dtype``.

    Every tag is read straight from the root by path (``$['age'].N``), so
    no intermediate variant is built and each lookup is one binary search in
    the variant's object index.
    """
    if isinstance(dtype, VariantType):
        return _get(v, path, "variant")
    s = _get(v, f"{path}.S", "string")
    n = _get(v, f"{path}.N", "string")
    b = _get(v, f"{path}.BOOL", "boolean")
    if isinstance(dtype, StringType):
        return F.coalesce(s, n, b.cast("string"))
    if isinstance(dtype, _INTEGRAL + _FRACTIONAL):
        return _number(n, dtype)
    if isinstance(dtype, BooleanType):
        return b
    if isinstance(dtype, BinaryType):
        return F.unbase64(_get(v, f"{path}.B", "string"))
    if isinstance(dtype, ArrayType):
        elem = dtype.elementType
        arms = [F.transform(_get(v, f"{path}.L", "array<variant>"), lambda x: decode_value(x, elem))]
        if isinstance(elem, StringType):
            arms.append(_get(v, f"{path}.SS", "array<string>"))
        elif isinstance(elem, _INTEGRAL + _FRACTIONAL):
            arms.append(F.transform(_get(v, f"{path}.NS", "array<string>"), lambda t: _number(t, elem)))
        elif isinstance(elem, BinaryType):
            arms.append(F.transform(_get(v, f"{path}.BS", "array<string>"), lambda t: F.unbase64(t)))
        return F.coalesce(*arms)
    if isinstance(dtype, StructType):
        m = f"{path}.M"
        present = _get(v, m, "variant").isNotNull()
        return F.when(present, F.struct(*[decode_value(v, f.dataType, f"{m}{_path(f.name)[1:]}").alias(f.name)
                                          for f in dtype.fields]))
    if isinstance(dtype, MapType):
        vt = dtype.valueType
        return F.transform_values(_get(v, f"{path}.M", "map<string,variant>"),
                                  lambda _k, x: decode_value(x, vt))
    raise TypeError(f"no decode rule for {dtype.simpleString()}")


def decode_attributes(image: Column, schema: StructType, null_image_is_null: bool = True) -> Column:
    """Decode a whole image into a struct shaped by ``schema``.

    Attributes absent from the image become null; attributes not named by the
    schema are ignored (column pruning of the raw image).  A null image gives
    a null struct, unless ``null_image_is_null=False``: callers that already
    dropped null images get a bare struct, whose unused fields the optimizer
    prunes (only the attributes read downstream are decoded).
    """
    fields = [decode_value(image, f.dataType, _path(f.name)).alias(f.name) for f in schema.fields]
    if not null_image_is_null:
        return F.struct(*fields)
    return F.when(image.isNotNull(), F.struct(*fields))


def _unparseable(text: Column) -> Column:
    number = F.when(text.contains("."), text.try_cast("double").isNotNull()).otherwise(text.try_cast("bigint").isNotNull())
    return text.isNotNull() & ~number


def raw_numbers(image: Column, schema: StructType) -> Column:
    """map<string,string> of numeric attributes whose N text does not parse; null when all do."""
    entries = []
    for f in schema.fields:
        if isinstance(f.dataType, _INTEGRAL + _FRACTIONAL):
            n = _get(image, f"{_path(f.name)}.N", "string")
            entries.append(F.when(_unparseable(n), F.struct(F.lit(f.name).alias("key"), n.alias("value"))))
    if not entries:
        return F.lit(None).cast("map<string,string>")
    kept = F.array_compact(F.array(*entries))
    return F.when(F.size(kept) > 0, F.map_from_entries(kept))


def bad_sets(image: Column) -> Column:
    """Whether some attribute is a number set with an element that does not parse."""
    # one walk of the image; what is no set comes as null
    sets = F.map_values(_get(image, "$", "map<string,struct<NS:array<string>>>"))
    return F.coalesce(F.exists(sets, lambda v: F.exists(v["NS"], _unparseable)), F.lit(False))


def image_size(image: Column) -> Column:
    """Number of attributes in an image; null image -> 0."""
    return F.coalesce(F.size(_get(image, "$", "map<string,variant>")), F.lit(0))


# ---------------------------------------------------------------- encoding ---
# The inverse direction builds tagged images from typed columns; used by the
# table writers (put a typed row as an item) and by the fixture mapping.

def _tag(c: Column, key: str) -> Column:
    # to_json drops the null field, so this renders {"S": ..} or {"NULL": true}
    return F.struct(c.alias(key), F.when(c.isNull(), F.lit(True)).alias("NULL"))


def tag_s(c: Column) -> Column:
    return _tag(c.cast("string"), "S")


def tag_n(c: Column) -> Column:
    return _tag(c.cast("string"), "N")


def encode_item(cols: dict[str, Column]) -> Column:
    """Build a tagged image (variant) from ``{name: tagged struct column}``.

    Every attribute is written, null ones as ``{"NULL": true}``, which is how
    the table stores an explicit None.
    """
    return F.parse_json(F.to_json(F.struct(*[c.alias(k) for k, c in cols.items()])))
