"""Pseudonymous copies of tables: person numbers hashed, e-mail addresses dropped.

User and session ids stay, and a person's hash is stable, so the result is pseudonymous, not anonymous.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.functions import hmac_sha256
from clickloom.schema import NUMBERED, SPELLINGS, quoted

PERSON = {s.lower() for s in SPELLINGS["gpn"]}
ADDRESS = {s.lower() for s in SPELLINGS["email"]}


def spelling(column: str) -> str:
    """Lower-case name without the number that tells case variants apart."""
    return NUMBERED.sub("", column.lower())


def hashed_name(column: str) -> str:
    number = NUMBERED.search(column)
    name = "CP_Person_Hash" if column.lower().startswith("cp_") else "person_hash"
    return name + (number[0] if number else "")


def anonymize(df: DataFrame, pepper: str) -> DataFrame:
    """Works on every accepted spelling, whatever its case, and on columns numbered for their case."""
    kept = [c for c in df.columns if spelling(c) not in ADDRESS]
    return df.select(
        *[
            hmac_sha256(quoted(c), pepper).alias(hashed_name(c))
            if spelling(c) in PERSON
            else quoted(c)
            for c in kept
        ]
    )
