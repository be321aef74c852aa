"""Text extraction and naming expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number patterns, file types that may be stored, length units in mm.
INTEGER_RE = r"(?U)\d+"
NUMBER_RE = r"(?U)\d+(?:\.\d+)?"
TRUSTED_EXTENSIONS = ("pdf", "html", "htm", "png", "jpg", "jpeg")
UNIT_MM = {"mm": 1, "cm": 10, "m": 1000}


def integers(value: Column) -> Column:
    """Every run of digits, in order, as strings: '13.5' gives 13 and 5."""
    return F.regexp_extract_all(value, F.lit(INTEGER_RE), F.lit(0))


def numbers(value: Column) -> Column:
    """Every unsigned decimal number, in order, as strings."""
    return F.regexp_extract_all(value, F.lit(NUMBER_RE), F.lit(0))


def groups(value: Column, pattern: str, count: int) -> Column:
    """Groups 1..count of the first match, or null without a match.

    Spark gives '' for a group that took no part in the match; it is turned into null.
    """
    parts = [F.nullif(F.regexp_extract(value, pattern, k), F.lit("")) for k in range(1, count + 1)]
    return F.when(value.rlike(pattern), F.array(*parts))


def matches(kind: Column, pattern: Column, value: Column) -> Column:
    """One of: exact equality, case-insensitive substring, regular expression found anywhere."""
    return (
        F.when(kind == "exact", value == pattern)
        .when(kind == "includes", F.contains(F.lower(value), F.lower(pattern)))
        .when(kind == "regex", F.rlike(value, pattern))
    )


def match_exact(value: Column, text: str) -> Column:
    return value == F.lit(text)


def match_includes(value: Column, text: str) -> Column:
    return F.contains(F.lower(value), F.lit(text.lower()))


def match_regex(value: Column, pattern: str) -> Column:
    return value.rlike(pattern)


def path_safe(model: Column, col_idx: Column) -> Column:
    """File-name form of a model name; 'col:<i>' when there is none."""
    named = F.btrim(F.replace(model, F.lit("/"), F.lit("_")), F.lit("."))
    return F.when(F.coalesce(model, F.lit("")) == "", F.concat(F.lit("col:"), col_idx.cast("string"))).otherwise(named)


def sanitise_group(group: Column) -> Column:
    return F.replace(group, F.lit("/"), F.lit("_"))


# A placeholder of a template.
PLACEHOLDER_RE = r"\{([^{}]*)\}"


def fill_template(template: Column, props: Column) -> Column:
    """Put the property of its name in place of each '{name}', all in one pass: what a property holds is
    not looked at again. An unknown name gives nothing; `unknown_names` lists those."""
    between = F.split(template, PLACEHOLDER_RE, -1)
    names = F.regexp_extract_all(template, F.lit(PLACEHOLDER_RE), F.lit(1))
    values = F.transform(names, lambda n: F.coalesce(F.try_element_at(props, n), F.lit("")))
    return F.array_join(F.flatten(F.zip_with(between, values, lambda t, v: F.array(t, F.coalesce(v, F.lit(""))))), "")


def unknown_names(template: Column, props: Column) -> Column:
    """Placeholders of a template that are no property."""
    names = F.regexp_extract_all(template, F.lit(PLACEHOLDER_RE), F.lit(1))
    return F.array_distinct(F.filter(names, lambda n: ~F.map_contains_key(props, n)))


def output_path(stem: Column, group: Column, stage: Column, filename: Column, ext: Column) -> Column:
    """<stem>/<group>/<stage>/<filename>.<ext>, with the group made safe for a path."""
    return F.concat(F.concat_ws("/", stem, sanitise_group(group), stage, filename), F.lit("."), ext)


def suffix(path: Column) -> Column:
    """Extension of the last path segment without the dot; '' if there is none."""
    return F.regexp_extract(path, r"[^/.][^/]*\.([^./]+)$", 1)


def trusted_extension(item: Column, url: Column) -> Column:
    """Extension of the item's name, else of the URL; null when neither is trusted."""
    own, remote = suffix(item), suffix(url)
    return F.when(own.isin(*TRUSTED_EXTENSIONS), own).when(remote.isin(*TRUSTED_EXTENSIONS), remote)


def item_stem(item: Column) -> Column:
    """Item name without its extension, if that extension is trusted."""
    own = suffix(item)
    return F.when(own.isin(*TRUSTED_EXTENSIONS), F.regexp_replace(item, r"\.[^./]+$", "")).otherwise(item)


def _quantity(text: Column) -> tuple[Column, Column]:
    amount = F.regexp_extract(text, r"^\s*([+-]?[0-9.]+)\s*(?:mm|cm|m)?$", 1).try_cast("double")
    unit = F.nullif(F.regexp_extract(text, r"(mm|cm|m)$", 1), F.lit(""))
    return amount, unit


def _to_mm(amount: Column, unit: Column) -> Column:
    factor = F.when(unit == "mm", UNIT_MM["mm"]).when(unit == "cm", UNIT_MM["cm"]).when(unit == "m", UNIT_MM["m"])
    return (amount * factor).cast("int")


def length_mm(text: Column) -> Column:
    """One length in mm (no unit = mm), cut to whole mm."""
    amount, unit = _quantity(text)
    return _to_mm(amount, F.coalesce(unit, F.lit("mm")))


def size_mm(text: Column) -> Column:
    """'AxB' as struct(w, h) in mm. A side without unit takes the other side's; none at all = mm."""
    sides = F.split(text, "x")
    (wa, wu), (ha, hu) = _quantity(F.try_element_at(sides, F.lit(1))), _quantity(F.try_element_at(sides, F.lit(2)))
    mm = F.lit("mm")
    good = F.size(sides) == 2
    return F.struct(
        F.when(good, _to_mm(wa, F.coalesce(wu, hu, mm))).alias("w"),
        F.when(good, _to_mm(ha, F.coalesce(hu, wu, mm))).alias("h"),
    )


def any_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
