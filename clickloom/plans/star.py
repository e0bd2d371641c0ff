"""Star schema: six dimensions with dense surrogate keys, and the event fact table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import hmac_sha256, normalize_gpn, or_empty
from clickloom.functions.times import iso_weekday
from clickloom.operators.numbering import with_dense_key
from clickloom.operators.validity import validity_periods, with_period
from clickloom.schema import HR_FIELDS, optional
from clickloom.sources.registry import KeyRegistry

UNKNOWN = "(unknown)"
ORG_FIELDS = [alias.removeprefix("hr_") for alias in HR_FIELDS.values()]


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_organization: DataFrame
    dim_site: DataFrame
    dim_page: DataFrame
    dim_link_type: DataFrame
    dim_component: DataFrame


def site_key(columns: list[str]) -> dict[str, Column]:
    return {f: or_empty(optional(columns, f)) for f in ("site_id", "site_name")}


def page_key(columns: list[str]) -> dict[str, Column]:
    fields = ("page_id", "page_name", "page_url", "content_type", "page_status")
    return {f: or_empty(optional(columns, f)) for f in fields}


def link_type_key(columns: list[str]) -> dict[str, Column]:
    return {"link_type": F.coalesce(optional(columns, "link_type"), F.lit(UNKNOWN))}


def component_key(columns: list[str]) -> dict[str, Column]:
    return {"component_name": F.coalesce(optional(columns, "component"), F.lit(UNKNOWN))}


def org_key(columns: list[str]) -> dict[str, Column]:
    """Organisation fields the events carry, NULL and '' taken as the same value."""
    return {
        alias.removeprefix("hr_"): F.nullif(F.col(alias).cast("string"), F.lit(""))
        for alias in HR_FIELDS.values()
        if alias in columns
    }


def org_hash(present: dict[str, Column]) -> Column:
    return F.md5(F.concat_ws("|", *[or_empty(c) for c in present.values()]))


def date_key(columns: list[str]) -> dict[str, Column]:
    return {"date_value": F.col("session_date")}


def organization_key(columns: list[str]) -> dict[str, Column]:
    """The hash of the fields present, and every field, so that keys stay comparable when fields come or go."""
    present = org_key(columns)
    missing = F.lit(None).cast("string")
    return {"org_hash": org_hash(present)} | {f: present.get(f, missing) for f in ORG_FIELDS} if present else {}


NATURAL_KEYS = {
    "date_key": date_key,
    "org_key": organization_key,
    "site_key": site_key,
    "page_key": page_key,
    "link_type_key": link_type_key,
    "component_key": component_key,
}


def natural_keys(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(dim, parts): the distinct natural keys of several dimensions, found in one scan and combined on the map side."""
    pairs = [
        F.struct(F.lit(key).alias("dim"), F.array(*[c.cast("string") for c in natural.values()]).alias("parts"))
        for key in keys
        if (natural := NATURAL_KEYS[key](events.columns))
    ]
    if not pairs:
        return events.sparkSession.createDataFrame([], "dim string, parts array<string>")
    undated = (F.col("dim") == "date_key") & F.get("parts", 0).isNull()
    return events.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*").where(~undated).distinct()


def numbered(events: DataFrame, keys: Sequence[str], registry: KeyRegistry | None = None) -> dict[str, DataFrame]:
    """The natural keys of several dimensions with their numbers.

    Without a registry the distinct keys of ``events`` are numbered from 1 in their order: all are sorted
    together, and each dimension takes its own stretch. With one, keys keep the numbers they have, new ones
    come after them, and keys that ``events`` does not hold are there as well.
    """
    naturals = {key: natural for key in keys if (natural := NATURAL_KEYS[key](events.columns))}
    if not naturals:
        return {}
    found = natural_keys(events, keys)
    if registry is not None:
        keyed, starts = registry.register(found), {}
    else:
        keyed = with_dense_key(found, ["dim", "parts"], "number")
        starts = {r["dim"]: r["first"] for r in keyed.groupBy("dim").agg(F.min("number").alias("first")).collect()}
    return {
        key: keyed.where(F.col("dim") == key).select(
            (F.col("number") - (starts.get(key, 1) - 1)).alias(key),
            *[F.get("parts", i).alias(name) for i, name in enumerate(natural)],
        )
        for key, natural in naturals.items()
    }


def _dated(keyed: DataFrame) -> DataFrame:
    day = F.col("date_value")
    return keyed.select("date_key", day.cast("date").alias("date_value")).select(
        "date_key",
        "date_value",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (iso_weekday(day) >= 6).alias("is_weekend"),
    )


def _organized(events: DataFrame, keyed: DataFrame | None) -> DataFrame:
    """One row per combination of organisation fields; a single empty row without any field."""
    if keyed is None:
        keyed = events.sparkSession.range(1).select(
            F.lit(1).cast("long").alias("org_key"), F.lit("").alias("org_hash")
        )
    missing = F.lit(None).cast("string")
    fields = [F.col(f) if f in keyed.columns else missing.alias(f) for f in ORG_FIELDS]
    return keyed.select("org_key", "org_hash", *fields)


def dim_date(events: DataFrame) -> DataFrame:
    return _dated(numbered(events, ["date_key"])["date_key"])


def dim_organization(events: DataFrame) -> DataFrame:
    return _organized(events, numbered(events, ["org_key"]).get("org_key"))


def dim_site(events: DataFrame) -> DataFrame:
    return numbered(events, ["site_key"])["site_key"]


def dim_page(events: DataFrame) -> DataFrame:
    return numbered(events, ["page_key"])["page_key"]


def dim_link_type(events: DataFrame) -> DataFrame:
    return numbered(events, ["link_type_key"])["link_type_key"]


def dim_component(events: DataFrame) -> DataFrame:
    return numbered(events, ["component_key"])["component_key"]


def dimensions(events: DataFrame, registry: KeyRegistry | None = None) -> Star:
    keyed = numbered(events, list(NATURAL_KEYS), registry)
    return Star(
        _dated(keyed["date_key"]),
        _organized(events, keyed.get("org_key")),
        keyed["site_key"],
        keyed["page_key"],
        keyed["link_type_key"],
        keyed["component_key"],
    )


def organization_history(hr: DataFrame, pad_gpn: bool = False) -> DataFrame:
    """The organisation of every person over time: org_version_key, gpn, valid_from, valid_to, is_current, fields."""
    fields = {source: alias.removeprefix("hr_") for source, alias in HR_FIELDS.items() if source in hr.columns}
    snapshots = hr.withColumn("gpn", normalize_gpn(F.col("gpn"))) if pad_gpn else hr
    periods = validity_periods(snapshots, "gpn", "snapshot_year", "snapshot_month", fields)
    missing = F.lit(None).cast("string")
    every = [F.col(f) if f in fields.values() else missing.alias(f) for f in ORG_FIELDS]
    placed = periods.select("gpn", "valid_from", "valid_to", "is_current", *every)
    return with_dense_key(placed, ["gpn", "valid_from"], "org_version_key")


def with_org_version(events: DataFrame, history: DataFrame) -> DataFrame:
    """Events with the key of the organisation version that holds in their UTC month (of the first one before all)."""
    return with_period(events, history, "gpn", F.to_date("timestamp"), "org_version_key")


def fact_event(events: DataFrame, star: Star, pepper: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per event with the key of each dimension, and the columns to ``keep``.

    The dimensions are tables of known size, so the optimizer broadcasts those below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges the rest (a large page dimension). Natural
    keys are unique, so no join multiplies rows.
    """
    columns = events.columns
    person = hmac_sha256(F.col("gpn"), pepper) if "gpn" in columns else F.lit(None).cast("string")

    def text(field: str) -> Column:
        return optional(columns, field).alias(field)

    plain = ["user_id", "session_id", "session_key", "timestamp", "timestamp_cet", "event_order"]
    plain += ["prev_event", "ms_since_prev_event", "sec_since_prev_event"]
    plain += ["time_since_prev_bucket", "event_hour", "event_weekday"]
    joins = [
        (star.dim_date, "date_key", {"date_value": F.col("session_date")}),
        (star.dim_organization, "org_key", organization_key(columns)),
        (star.dim_site, "site_key", site_key(columns)),
        (star.dim_page, "page_key", page_key(columns)),
        (star.dim_link_type, "link_type_key", link_type_key(columns)),
        (star.dim_component, "component_key", component_key(columns)),
    ]
    natural = {f"__{key}_{f}": c for _, key, by in joins for f, c in by.items()}
    facts = events.select(
        person.alias("person_hash"),
        *plain,
        *[text(f) for f in ("link_address", "link_label", "file_name", "file_type")],
        F.col("name").alias("event_name"),
        text("client_country"),
        *keep,
        *[c.alias(alias) for alias, c in natural.items()],
    )
    for dim, key, by in joins:
        if not by:  # the one-row organisation dimension
            facts = facts.withColumn(key, F.lit(1).cast("long"))
            continue
        right = dim.select(key, *[F.col(f).alias(f"__d_{f}") for f in by])
        pairs = [(F.col(f"__{key}_{f}"), F.col(f"__d_{f}")) for f in by]
        nullable = key == "org_key"  # all other natural keys are free of NULLs on the dimension side
        same = [a.eqNullSafe(b) if nullable else a == b for a, b in pairs]
        facts = facts.join(right, reduce(and_, same), "left").drop(*[f"__d_{f}" for f in by])
    keys = [key for _, key, _ in joins]
    return facts.select(*keys, *[c for c in facts.columns if c not in natural and c not in keys])
