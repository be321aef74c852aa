"""Typed device record: schema, coercion of mapped text, nesting of dotted paths."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.functions.text import any_of



def _field(name: str, kind: T.DataType, units: str | None = None) -> T.StructField:
    return T.StructField(name, kind, True, {"units": units} if units else {})


def _range(kind: T.DataType) -> T.StructType:
    return T.StructType([_field("min", kind), _field("max", kind)])


_INT, _DOUBLE, _TEXT = T.IntegerType(), T.DoubleType(), T.StringType()

# Field names, types and units of the vendor-neutral device record
# (the spellings "weigth" and "noice" are field names of the output format).
DEVICE = T.StructType(
    [
        _field("brand", _TEXT),
        _field("model", _TEXT),
        _field("tags", T.ArrayType(_TEXT)),
        _field(
            "pv_input",
            T.StructType(
                [
                    _field("v_nom", _INT, "V"),
                    _field("v_crit", _range(_INT), "V"),
                    _field("v_mppt", _range(_INT), "V"),
                    _field("v_start", _range(_INT), "V"),
                    _field("w_max", _INT, "W"),
                    _field("i_nom", T.ArrayType(_DOUBLE), "A"),
                    _field("i_sc", T.ArrayType(_DOUBLE), "A"),
                    _field("n_mppt", _INT, "n"),
                    _field("n_str", T.ArrayType(_INT), "n"),
                ]
            ),
        ),
        _field(
            "battery_input",
            T.StructType(
                [
                    _field("v_nom", _INT, "V"),
                    _field("v_range", _range(_INT), "V"),
                    _field("i_charge_ac", _DOUBLE, "A"),
                    _field("i_charge_pv", _DOUBLE, "A"),
                    _field("i_invert", _DOUBLE, "A"),
                    _field("w_invert", _INT, "W"),
                ]
            ),
        ),
        _field(
            "general_data",
            T.StructType(
                [
                    _field(
                        "size",
                        T.StructType([_field("width", _DOUBLE), _field("height", _DOUBLE), _field("depth", _DOUBLE)]),
                        "mm",
                    ),
                    _field("weigth", _DOUBLE, "kg"),
                    _field("noice", _DOUBLE, "dB"),
                ]
            ),
        ),
    ]
)


def leaves(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Dotted path and type of every leaf."""
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            yield from leaves(f.dataType, f"{path}.")
        else:
            yield path, f.dataType


def leaf_types(schema: T.StructType) -> dict[str, T.DataType]:
    return dict(leaves(schema))


def check_targets(schema: T.StructType, targets: list[str]) -> None:
    """Plan-time check: every target must be a leaf of the record."""
    known = leaf_types(schema)
    bad = [t for t in targets if t not in known]
    if bad:
        raise ValueError(f"not a leaf of the record: {', '.join(sorted(bad))}")


def array_targets(schema: T.StructType) -> list[str]:
    return [p for p, t in leaves(schema) if isinstance(t, T.ArrayType)]


def coerce(values: Column, kind: T.DataType) -> Column:
    """Array of extracted strings to the leaf's type; null where the text does not fit."""
    if isinstance(kind, T.ArrayType):
        return F.transform(values, lambda v: coerce_one(v, kind.elementType))
    return coerce_one(F.try_element_at(values, F.lit(1)), kind)


# Texts that are whole and decimal numbers.
WHOLE_RE = r"^[+-]?[0-9]+$"
DECIMAL_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def coerce_one(text: Column, kind: T.DataType) -> Column:
    """The text as the type, or null where it is no number of that kind; a cast alone would also take
    suffixes such as 20d."""
    if isinstance(kind, T.StringType):
        return text
    bare = F.btrim(text)
    return F.when(bare.rlike(WHOLE_RE if isinstance(kind, T.IntegerType) else DECIMAL_RE), bare.try_cast(kind))


def is_bad(values: Column, kind: T.DataType) -> Column:
    """True when some extracted text does not fit the leaf's type."""
    if isinstance(kind, T.ArrayType):
        return F.exists(values, lambda v: v.isNotNull() & coerce_one(v, kind.elementType).isNull())
    first = F.try_element_at(values, F.lit(1))
    return first.isNotNull() & coerce_one(first, kind).isNull()


def nest(schema: T.StructType, leaf: dict[str, Column], prefix: str = "") -> list[Column]:
    """Record fields from flat leaves; a parent is null unless one of its leaves is set."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            under = [p for p, _ in leaves(f.dataType, f"{path}.")]
            present = any_of(leaf[p].isNotNull() for p in under if p in leaf)
            value = F.when(present, F.struct(*nest(f.dataType, leaf, f"{path}.")))
        else:
            value = leaf.get(path, F.lit(None)).cast(f.dataType)
        out.append(value.alias(f.name))
    return out


def get_path(root: str, path: str) -> Column:
    """Read a dotted path below a column; digits index an array; null when a parent is missing."""
    return _walk(F.col(root), path.split("."))


def get_path_in(path: str) -> Column:
    """Read a dotted path of the row itself."""
    first, *rest = path.split(".")
    return _walk(F.col(first), rest)


def _walk(value: Column, pieces: list[str]) -> Column:
    for piece in pieces:
        value = F.try_element_at(value, F.lit(int(piece) + 1)) if piece.isdigit() else value[piece]
    return value
