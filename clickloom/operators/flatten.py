"""Nested JSON properties of raw log rows: parse, unpack into columns, discover keys."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickloom.functions import or_empty, peppered_sha256
from clickloom.schema import quoted

CLICK_EVENT = "click_event"
DETAILS = "customDimensions"
PREFIX = "CP_"
LOG_COLUMNS = ("timestamp", "name", "client_CountryOrRegion", "user_Id", "session_Id")


def recent(log: DataFrame, as_of: datetime, days: int, name: str | None = CLICK_EVENT) -> DataFrame:
    """Log rows of the ``days`` before ``as_of``, of one event name; both filters reach the scan."""
    since = F.lit(as_of) - F.expr(f"INTERVAL '{int(days)}' DAY")
    rows = log.where(F.col("timestamp") >= since)
    return rows if name is None else rows.where(F.col("name") == name)


def properties_text() -> Column:
    """The inner JSON document, kept as a string inside the outer one."""
    return F.get_json_object(F.col(DETAILS), "$.CustomProps")


def property_bag() -> Column:
    """All properties as a map; empty for missing, malformed or non-object documents."""
    text = properties_text()
    parsed = F.when(text.startswith("{"), F.from_json(text, "map<string,string>"))
    return F.coalesce(_nulls_as_blank(parsed), F.create_map().cast("map<string,string>"))


def _nulls_as_blank(bag: Column) -> Column:
    return F.transform_values(bag, lambda _, value: F.coalesce(value, F.lit("")))


def _record(text: Column, keys: Sequence[str]) -> Column:
    """The wanted properties of a document as a struct of texts, in one parse."""
    schema = T.StructType([T.StructField(key, T.StringType()) for key in dict.fromkeys(keys)])
    # An array document would be read as its first element.
    return F.when(~F.ltrim(text).startswith("["), F.from_json(text, schema))


def with_properties(log: DataFrame, wanted: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` plus one text column per wanted property ('' when absent): alias -> key."""
    read = log.select(*keep, properties_text().alias("__text"))
    parsed = read.select(*keep, _record(F.col("__text"), list(wanted.values())).alias("__p"))
    return parsed.select(
        *keep, *[or_empty(F.col("__p")[key]).alias(alias) for alias, key in wanted.items()]
    )


def _documents(log: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the property document as a variant, parsed once; NULL unless it is an object."""
    read = log.select(*keep, properties_text().alias("__text"))
    document = F.when(F.col("__text").startswith("{"), F.try_parse_json("__text"))
    return read.select(*keep, document.alias("__doc"))


def discovered(log: DataFrame) -> dict[str, bool]:
    """All property keys in the data, sorted, and whether each is a JSON null somewhere.

    Runs a job; a short text and a flag per key and task are shuffled. Every key is going to be a column of a
    table, so their list fits the driver.
    """
    entries = _documents(log).select(F.explode(F.col("__doc").cast("map<string,variant>")).alias("key", "value"))
    found = entries.select("key", F.is_variant_null("value").alias("null")).distinct().collect()
    return {key: any(r["null"] for r in found if r["key"] == key) for key in sorted({r["key"] for r in found})}


def discovered_keys(log: DataFrame) -> list[str]:
    return list(discovered(log))


def column_names(keys: Sequence[str], prefix: str = PREFIX) -> dict[str, str]:
    """Key -> column. Keys that differ in case alone get a number, as column names compare without case."""
    taken: set[str] = {c.lower() for c in LOG_COLUMNS}
    names = {}
    for key in dict.fromkeys(keys):
        name, n = prefix + key, 0
        while name.lower() in taken:
            n += 1
            name = f"{prefix}{key}_{n}"
        taken.add(name.lower())
        names[key] = name
    return names


def flatten(log: DataFrame, keys: Sequence[str] | None = None, prefix: str = PREFIX) -> DataFrame:
    """One column per property key (see ``column_names``), one row per event; absent keys are NULL, JSON nulls are ''.

    Without ``keys`` every key that the log holds becomes a column, which takes a pass over it to find them.
    Each document is parsed once, into a variant that is then cast to a struct: of texts for keys that are
    never null, of variants for others, since only these tell a JSON null from an absent key. Keys match
    exactly; those that differ in case alone cannot be fields of one struct and get structs of their own.
    Nested values are JSON text, numbers are written in their shortest form.
    """
    nullable = discovered(log) if keys is None else dict.fromkeys(keys, True)
    return _flattened(log, nullable, prefix)


def _flattened(log: DataFrame, nullable: Mapping[str, bool], prefix: str) -> DataFrame:
    # The first spelling of every key, then the second of those that have one, and so on.
    structs: list[list[str]] = []
    spelled: Counter[str] = Counter()
    place: dict[str, str] = {}
    for key in nullable:
        n = spelled[key.lower()]
        spelled[key.lower()] += 1
        if n == len(structs):
            structs.append([])
        structs[n].append(key)
        place[key] = f"__p{n}"
    types = {key: T.VariantType() if null else T.StringType() for key, null in nullable.items()}
    schemas = [T.StructType([T.StructField(key, types[key]) for key in keys]) for keys in structs]
    parsed = [F.col("__doc").cast(schema).alias(f"__p{n}") for n, schema in enumerate(schemas)]
    rows = _documents(log, *LOG_COLUMNS).select(*LOG_COLUMNS, *parsed)

    def value(key: str) -> Column:
        found = F.col(place[key])[key]
        return F.when(found.isNotNull(), or_empty(found.cast("string"))) if nullable[key] else found

    names = column_names(list(nullable), prefix)
    return rows.select(*LOG_COLUMNS, *[value(key).alias(name) for key, name in names.items()])


def key_inventory(log: DataFrame, approx_error: float | None = None) -> DataFrame:
    """Per property key: events that carry it, distinct values, and the smallest value as sample.

    Exact counting goes by (key, value) first, which is combined on the map side and spreads a key that
    every event carries over all its values. With ``approx_error`` the values are sketched and only one
    row per key and task is shuffled.
    """
    pairs = log.select(F.explode(property_bag()).alias("key", "value"))
    if approx_error is not None:
        return pairs.groupBy("key").agg(
            F.count("*").alias("key_count"),
            F.approx_count_distinct("value", approx_error).alias("distinct_values"),
            F.min("value").alias("sample_value"),
        )
    per_value = pairs.groupBy("key", "value").agg(F.count("*").alias("n"))
    return per_value.groupBy("key").agg(
        F.sum("n").alias("key_count"),
        F.count("*").alias("distinct_values"),
        F.min("value").alias("sample_value"),
    )


def export_view(flat: DataFrame, newest_first: bool = False) -> DataFrame:
    """Flat rows with the time as day-first text of seven fraction digits, as exports carry it.

    ``newest_first`` adds a global sort by the time itself.
    """
    rows = flat.orderBy(F.desc("timestamp")) if newest_first else flat
    text = F.concat(F.date_format("timestamp", "dd/MM/yyyy HH:mm:ss.SSSSSS"), F.lit("0"))
    rest = [c for c in flat.columns if c != "timestamp"]
    return rows.select(text.alias("timestamp [UTC]"), *rest)


def pseudonymous_flat(
    log: DataFrame, pepper: str, keys: Sequence[str] | None = None, prefix: str = PREFIX
) -> DataFrame:
    """Flat rows with the person number hashed (unkeyed, peppered form) and no e-mail address, in any spelling."""
    nullable = discovered(log) if keys is None else dict.fromkeys(keys, True)
    kept = {key: null for key, null in nullable.items() if key.lower() != "email"}
    names = column_names(list(kept), prefix)
    people = [name for key, name in names.items() if key.lower() == "gpn"]
    return _flattened(log, kept, prefix).withColumns({c: peppered_sha256(quoted(c), pepper) for c in people})


def with_email_containing(log: DataFrame, needle: str) -> DataFrame:
    """Log rows whose e-mail property contains ``needle``, ignoring case."""
    address = F.get_json_object(properties_text(), "$.Email")
    return log.where(F.lower(address).contains(needle.lower()))
