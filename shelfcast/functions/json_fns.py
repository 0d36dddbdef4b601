"""JSON column functions over Spark's VARIANT type (parse once, then paths)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(text: Column | str) -> Column:
    """Text -> VARIANT; malformed text gives NULL instead of failing the job."""
    return F.try_parse_json(_col(text))


def variant_to_json(v: Column) -> Column:
    """VARIANT -> canonical text (keys sorted, compact); JSON null -> SQL NULL.

    An object is written as a map of its members, in their order: within a VARIANT each key
    and each string gets a JSON writer of its own, which was half the time of the silver step.
    """
    return sub_to_json(v, "$")


def sub_to_json(v: Column, json_path: str) -> Column:
    """Canonical text of the sub-document at a JSON path (see ``variant_to_json``), which is not copied out for it."""
    members = F.try_variant_get(v, json_path, "map<string,variant>")  # NULL where it is no object
    other = v if json_path == "$" else sub(v, json_path)
    # is_variant_null(NULL) is NULL: nothing there is NULL as well
    return F.coalesce(F.to_json(members), F.when(~F.is_variant_null(other), F.to_json(other)))


# One member, compact, plain printable text or a short whole number: its canonical text is itself.
ONE_PLAIN_MEMBER = r'^\{"[A-Za-z0-9_]+":("[ !#-\[\]-~]*"|0|-?[1-9][0-9]{0,17}|true|false|null)\}\z'


def canonical_text(text: Column | str, parsed: Column) -> Column:
    """Canonical text of ``text``, whose parsed form is ``parsed``.

    Most message keys are one plain member and stay as they are: writing each string
    of a VARIANT costs more than a match of the whole text."""
    return F.when(_col(text).rlike(ONE_PLAIN_MEMBER), _col(text)).otherwise(variant_to_json(parsed))


def canonical_json(text: Column | str) -> Column:
    """Text -> canonical JSON text: sorted keys at every depth, no whitespace."""
    return variant_to_json(parse(text))


def path(v: Column, json_path: str, type_name: str = "string") -> Column:
    """Typed value at a JSON path; missing path or impossible cast -> NULL."""
    return F.try_variant_get(v, json_path, type_name)


def sub(v: Column, json_path: str) -> Column:
    """Sub-document at a JSON path as VARIANT."""
    return F.try_variant_get(v, json_path, "variant")
