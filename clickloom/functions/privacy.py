"""Keyed hashes composed from built-in expressions, so no row leaves the JVM.

The key ends up as a literal in the query plan; set ``spark.sql.redaction.string.regex`` when plans are
shown to people who must not see it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

BLOCK_BYTES = 64


def hmac_sha256(value: Column, key: str) -> Column:
    """HMAC-SHA256 of ``value`` as hex text; NULL for NULL and blank values."""
    raw = key.encode("utf-8")
    if len(raw) > BLOCK_BYTES:
        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(BLOCK_BYTES, b"\0")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in raw))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in raw))
    text = value.cast("string")
    inner = F.unhex(F.sha2(F.concat(inner_pad, F.encode(text, "UTF-8")), 256))
    return F.when(text.rlike(r"\S"), F.sha2(F.concat(outer_pad, inner), 256))


def peppered_sha256(value: Column, pepper: str) -> Column:
    """SHA-256 of the pepper followed by the value (NULL counts as '')."""
    return F.sha2(F.concat(F.lit(pepper), F.coalesce(value.cast("string"), F.lit(""))), 256)
