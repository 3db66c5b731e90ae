"""Folders for files that queries derive, and SQL pieces that several oracles share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shroud.operators.keys import KeyTable
from shroud.sources.scratch import discard, work_dir, written  # noqa: F401  the plans take them from here

#: Fixed resource of the derived inputs.
RESOURCE = "bigquery:proj.ds.users"


def key_table(keys: DataFrame) -> KeyTable:
    """A table of the given keys in a folder of its own."""
    made = KeyTable(keys.sparkSession, work_dir(keys.sparkSession, "keys"))
    made.add(keys)
    return made


def hmac_sql(h: str, v: str) -> str:
    """HMAC-SHA256 in DuckDB: ``h`` is a 64-digit hex key, ``v`` a text."""

    def xorpad(word: int) -> str:
        return f"list_aggregate(list_transform(range(8), lambda i: printf('%08x', xor(CAST('0x' || substr({h}, CAST(1 + 8*i AS INT), 8) AS BIGINT), {word}))), 'string_agg', '')"

    inner = f"sha256(unhex({xorpad(0x36363636)} || repeat('36', 32)) || encode({v}))"
    return f"sha256(unhex({xorpad(0x5C5C5C5C)} || repeat('5c', 32)) || unhex({inner}))"


#: A valid e-mail in DuckDB, as the library's syntax has it.
def email_sql(column: str) -> str:
    from shroud.functions.text import EMAIL_LOCAL, EMAIL_SYNTAX

    return f"(regexp_matches({column}, '{EMAIL_SYNTAX}') AND instr({column}, '@') <= {EMAIL_LOCAL + 1})"


def classify_sql(column: str) -> str:
    """Pattern of a cell in DuckDB."""
    from shroud.functions.text import PATTERNS

    cell = f"regexp_replace({column}, '^\\s+|\\s+$', '', 'g')"
    whens = [f"WHEN regexp_matches({cell}, '{p.replace(chr(39), chr(39) * 2)}') THEN '{name}'" for name, p in PATTERNS.items()]
    return "CASE " + " ".join(whens) + " END"
