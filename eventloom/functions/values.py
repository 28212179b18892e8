"""Attribute values: from the raw JSON token to the type the catalog names.

Raw attributes are parsed as text (``array`` ones as variant), so a number sent
as a string and a string sent as a number both reach their declared type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The type tags a catalog may use, with the type each attribute is
# parsed as and published as.
PARSED_TYPE = {
    "string": "string",
    "long": "string",
    "boolean": "string",
    "double": "string",
    "array": "variant",
}


JSON_NUMBER = r"^\s*-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\s*$"


def is_nested(raw: Column, packet: Column, name: str) -> Column:
    """Whether an attribute parsed as text was a JSON object or array.

    A text may begin like one; only then is the packet looked at again.
    """
    whole = F.variant_get(F.try_parse_json(packet), f"$['{name}']", "variant")
    return F.when(
        F.left(F.trim(raw), F.lit(1)).isin("{", "["),
        F.coalesce(F.schema_of_variant(whole).rlike("^(OBJECT|ARRAY)"), F.lit(False)),
    ).otherwise(F.lit(False))


def typed_value(raw: Column, tag: str, nested: Column | None = None) -> Column:
    """The raw attribute in its catalog type; null where it cannot be converted.

    ``nested`` says where a text attribute was an object or array, which only ``array``
    takes.  A boolean is true for the text true in any case and false for any other scalar;
    a double must be a finite JSON number.
    """
    if nested is not None and tag in ("string", "boolean"):
        raw = F.when(~nested, raw)
    if tag == "string":
        return raw
    if tag == "long":
        whole = raw.try_cast("bigint")
        # 12.0 and 1e3 are whole numbers too; fractions are cut off
        return F.coalesce(whole, raw.try_cast("decimal(38,9)").try_cast("bigint"))
    if tag == "boolean":
        return F.lower(raw) == "true"
    if tag == "double":
        number = F.when(raw.rlike(JSON_NUMBER), raw.try_cast("double"))
        return F.when(F.abs(number) < float("inf"), number)
    if tag == "array":
        # objects and arrays pass through, scalars do not
        return F.when(F.to_json(raw).rlike(r"^[\[{]"), raw)
    raise ValueError(f"unsupported type tag {tag!r}")


def value_is_bad(raw: Column, typed: Column) -> Column:
    """True where a value was sent but does not fit its catalog type."""
    return raw.isNotNull() & typed.isNull()
