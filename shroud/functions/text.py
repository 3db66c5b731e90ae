"""Text rules as Column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of personal data, tried in this order on the stripped cell.
PATTERNS = {
    "EMAIL": r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
    "PHONE": r"^\+?[0-9][0-9 .()\-]{6,}[0-9]$",
    "NAME": r"^[A-Z][a-z]+(?:[ '-][A-Z][a-z]+)+$",
}
# Words that mark a metadata key as sensitive.
SENSITIVE = ("address", "decrypted", "email", "first_name", "full_name", "last_name", "name", "phone", "plaintext", "raw_pii", "ssn")
REDACTED = "<redacted>"
#: E-mail addresses that are taken: dot-atom local part, host labels without edge hyphens, a top label of letters.
EMAIL_SYNTAX = r"^[A-Za-z0-9!#$%&*+/=?^_{|}~-]+(\.[A-Za-z0-9!#$%&*+/=?^_{|}~-]+)*@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}$"
EMAIL_LOCAL = 64


def strip(value: Column) -> Column:
    """Without white space, of any kind, at both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def classify(value: Column) -> Column:
    """Name of the first pattern that the stripped cell has, else null."""
    found, cell = F.lit(None).cast("string"), strip(value)
    for name, pattern in reversed(PATTERNS.items()):
        found = F.when(cell.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def enabled(pattern: Column, patterns: list[str]) -> Column:
    """The pattern if it is enabled (all are if none is named), else null: no later pattern takes its place."""
    return F.when(pattern.isin(patterns), pattern) if patterns else pattern


def valid_email(value: Column) -> Column:
    return value.rlike(EMAIL_SYNTAX) & (F.instr(value, "@") <= EMAIL_LOCAL + 1)


def glob_regex(pattern: str) -> str:
    """Anchored regular expression of a shell pattern with *, ?, [..] and [!..]; case counts."""
    out, rest = "", pattern
    while rest:
        sign, rest = rest[0], rest[1:]
        closing = rest.find("]", 2 if rest[:1] == "!" else 1)
        if sign == "[" and closing > 0:
            inner, rest = rest[:closing], rest[closing + 1 :]
            negate, inner = ("^", inner[1:]) if inner[0] == "!" else ("", inner)
            inner = re.sub(r"([\\^\[&~])", r"\\\1", inner)
            out += f"[{negate}{inner}]"
        else:
            out += {"*": ".*", "?": "."}.get(sign, re.sub(r"([^A-Za-z0-9_ ])", r"\\\1", sign))
    return f"^(?s:{out})$"


def excluded(schema: Column, table: Column, patterns: list[str]) -> Column:
    """Whether the table, or schema.table, has one of the patterns."""
    found = F.lit(False)
    for p in patterns:
        found = found | table.rlike(glob_regex(p)) | F.concat_ws(".", schema, table).rlike(glob_regex(p))
    return found


def non_empty(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def comma_list(value: Column) -> Column:
    """Trimmed, non-blank parts of a comma list."""
    return F.filter(F.transform(F.split(value, ","), strip), lambda x: x != "")


def table_reference(resource_id: Column) -> Column:
    """struct(project, dataset, table) of ``bigquery:project.dataset.table``; null unless it has exactly three parts."""
    pattern = r"^bigquery:([^.]+)\.([^.]+)\.([^.]+)$"
    part = lambda k: F.regexp_extract(resource_id, pattern, k)
    return F.when(resource_id.rlike(pattern), F.struct(part(1).alias("project"), part(2).alias("dataset"), part(3).alias("table")))


def resource_id(catalog: Column, schema: Column, table: Column) -> Column:
    return F.concat(F.lit("bigquery:"), catalog, F.lit("."), schema, F.lit("."), table)


def redact(metadata: Column, of_bytes: bool = False) -> Column:
    """A flat map with the values of sensitive keys replaced, as text; with ``of_bytes`` the other values are bytes and become ``<n bytes>``."""
    shown = lambda v: F.concat(F.lit("<"), F.octet_length(v).cast("string"), F.lit(" bytes>")) if of_bytes else v.cast("string")
    return F.transform_values(metadata, lambda k, v: F.when(F.lower(k).rlike("|".join(SENSITIVE)), F.lit(REDACTED)).otherwise(shown(v)))


def json_safe(value: Column, kind: str) -> Column:
    """Text of a cell: dates and times in ISO form, an instant with the session's offset, bytes as UTF-8 with replacements, others as Spark writes them."""
    if kind in ("timestamp", "timestamp_ntz"):  # a fraction is shown, with six digits, if there is one
        zone = "xxx" if kind == "timestamp" else ""
        whole = F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss{zone}")
        return F.when(F.date_format(value, "SSSSSS") == "000000", whole).otherwise(F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{zone}"))
    if kind == "date":
        return F.date_format(value, "yyyy-MM-dd")
    if kind == "binary":
        return F.decode(value, "UTF-8")
    return value.cast("string")
