"""String rules: versions, name ids, locations, contexts, flow kinds, search tokens, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Location names and their codes.
LOCATIONS = {"United States of America (the)": "US", "Northern America": "RNA", "Global": "GLO", "Europe": "RER"}
#: Namespace of foreground ids.
NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
COPRODUCT = "__co__"


def parse_version(version: Column) -> Column:
    """'00.01.014' as an array of integers; parts that are no number count as 0."""
    return F.transform(F.split(F.coalesce(version, F.lit("")), "[.]"), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))


def name_uuid(name: Column, namespace: str = NAMESPACE) -> Column:
    """Version 5 UUID of the trimmed, lower-case name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(F.lower(F.trim(name)), "UTF-8")))
    variant = F.element_at(F.array(*(F.lit(x) for x in "89ab")), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1)
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def location_code(name: Column) -> Column:
    """Mapped names by code, others without what follows ' ('; blank is global."""
    mapped = F.create_map(*(F.lit(x) for pair in LOCATIONS.items() for x in pair))
    bare = F.nullif(F.trim(F.element_at(F.split(name, " \\("), 1)), F.lit(""))
    return F.coalesce(F.try_element_at(mapped, name), bare, F.lit("GLO"))


def categories(context: Column) -> Column:
    """Context path as an array; blank becomes ['unspecified']."""
    parts = F.filter(F.transform(F.split(F.coalesce(context, F.lit("")), "/"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(parts) == 0, F.array(F.lit("unspecified"))).otherwise(parts)


def flow_kind(context: Column, class_: Column) -> Column:
    resource = F.lower(F.coalesce(context, F.lit(""))).startswith("resource") | F.lower(F.coalesce(class_, F.lit(""))).contains("resource")
    return F.when(resource, "natural resource").otherwise("emission")


def tokens(query: Column) -> Column:
    return F.filter(F.split(F.lower(F.trim(query)), "\\s+"), lambda t: t != "")


def head_segment(name: Column) -> Column:
    return F.trim(F.element_at(F.split(F.lower(name), ";"), 1))


def coproduct_name(name: Column, flow: Column) -> Column:
    return F.concat(name, F.lit(" [causal co-product: "), flow, F.lit("]"))


def coproduct_code(code: Column, flow: Column) -> Column:
    return F.concat(code, F.lit(COPRODUCT), flow)


def is_coproduct(code: Column) -> Column:
    return code.contains(COPRODUCT)


def functional_unit(unit: Column) -> Column:
    return F.coalesce(F.concat(F.lit("1 "), F.nullif(F.trim(unit), F.lit(""))), F.lit("unit"))
