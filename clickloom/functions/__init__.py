"""Column expressions; every one stays inside the JVM."""

from clickloom.functions.privacy import hmac_sha256, peppered_sha256
from clickloom.functions.text import link_host, normalize_gpn, or_empty, thousands
from clickloom.functions.times import gap_bucket, millis_between, parse_export_time, utc_to_local

__all__ = [
    "gap_bucket",
    "hmac_sha256",
    "link_host",
    "millis_between",
    "normalize_gpn",
    "or_empty",
    "parse_export_time",
    "peppered_sha256",
    "thousands",
    "utc_to_local",
]
