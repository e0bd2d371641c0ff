"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.views import (
    AS_OF,
    FLAT,
    HR_PRESENT,
    ORG_HASH,
    ORG_TEXTS,
    PEPPER,
    hmac,
    prop,
    rounded,
    stamp,
    with_base,
    with_dims,
    with_events,
    with_log,
    with_video,
)
from oracle.bindings import PROPERTIES
from oracle.deliveries import DATES, STORED
from oracle.maintained import CUT, FROM, TO

# What the bindings write into the properties of an event, and the end of its column's name.
KEYS = {"ContentOwner": "ContentOwner"} | {k: k for k in PROPERTIES} | {"gpn": "gpn_1"}
TS = '"timestamp"'
NAMED = "name, client_CountryOrRegion, user_id as user_Id, session_id as session_Id"


def fmt(n: str) -> str:
    return f"replace(format('{{:,}}', {n}), ',', '''')"


def flat_columns(prefix: str, skip: tuple[str, ...] = ()) -> str:
    return ", ".join(
        f"case when json_type(cp, '$.{k}') is not null then {prop(k)} end as {prefix}{column}"
        for k, column in KEYS.items()
        if k not in skip
    )


# Organisation versions of every person, from the snapshots as the as-of join reads them.
_now = [f"coalesce({f}, lead({f}) over w) as {f}" for f in HR_PRESENT]
_same = " and ".join(f"{f} is not distinct from lag({f}) over w" for f in HR_PRESENT)
HISTORY_FIELDS = ", ".join(f'{f} as "{a.removeprefix("hr_")}"' for f, a in HR_PRESENT.items())
HISTORY = f""",
  held as (
    select gpn, row_number() over w as k, make_date(month_no // 100, month_no % 100, 1) as valid_from, {", ".join(_now)}
    from snapshots window w as (partition by gpn order by month_no)
    union all
    select gpn, 0, null, {", ".join(HR_PRESENT)} from snapshots
    qualify row_number() over (partition by gpn order by month_no) = 1),
  begun as (
    select *, k > 0 and {_same} as goes_on from held window w as (partition by gpn order by k)),
  versions as (
    select *, row_number() over (order by gpn, valid_from nulls first) as version,
      lead(valid_from) over (partition by gpn order by k) - 1 as valid_to
    from begun where not goes_on)
"""

# Facts without their keys, and events with the natural keys.
FACT_COLUMNS = f"""
  {hmac('e.gpn')} as person_hash, e.user_id, e.session_id, e.session_key,
  {stamp(f'e.{TS}')} as "timestamp", {stamp('e.timestamp_cet')} as timestamp_cet,
  cast(e.event_order as int) as event_order, e.prev_event,
  cast(e.ms_since_prev_event as double) as ms_since_prev_event,
  e.sec_since_prev_event, e.time_since_prev_bucket, e.event_hour, e.event_weekday,
  CP_Link_address as link_address, CP_Link_label as link_label, CP_FileName_Label as file_name,
  CP_FileType_Label as file_type, e.name as event_name, client_CountryOrRegion as client_country"""
FACT_ROWS = f"""(
  select *, session_date as date_value, {ORG_HASH} as org_hash,
    coalesce(CP_SiteID, '') as site_id, coalesce(CP_SiteName, '') as site_name,
    coalesce(CP_PageId, '') as page_id, coalesce(CP_PageName, '') as page_name,
    coalesce(CP_PageURL, '') as page_url, coalesce(CP_ContentType, '') as content_type,
    coalesce(CP_PageStatus, '') as page_status, coalesce(CP_Link_Type, '(unknown)') as link_type,
    coalesce(CP_ComponentName, '(unknown)') as component_name from ev) e"""


def share(value: str, name: str, limit: str = "") -> str:
    pct = rounded("100e0 * count(*) / sum(count(*)) over ()", 1)
    return with_events(
        f"select {value} as {name}, count(*) as cnt, {pct} as pct from ev group by 1 "
        f"order by cnt desc, 1 {limit}"
    )


def sample(value: str, k: int, where: str = "true") -> str:
    return (
        f"array_to_string(list_slice(list_sort(list(distinct {value}) filter ({where})), 1, {k}), '|')"
    )


def coverage() -> str:
    names = ["gpn", "email", "session_id", "user_id", *HR_PRESENT.values()]
    names += ["CP_" + k for k in PROPERTIES]
    rows = " union all ".join(
        f"select '{c}' as field, count({c}) as filled, count(*) as total, "
        f"{rounded(f'100e0 * count({c}) / count(*)', 1)} as pct from ev"
        for c in names
    )
    return with_events(rows)


ORACLE: dict[str, str] = {
    "daily_trend": with_log(
        f"select {stamp(f'cast(cast({TS} as date) as timestamp)')} as day, "
        "count(*) as daily_events from log group by 1"
    ),
    "daily_trend_90d": with_log(
        f"select {stamp(f'cast(cast({TS} as date) as timestamp)')} as day, count(*) as daily_events from log "
        f"where {TS} >= {AS_OF} - interval 90 day group by 1"
    ),
    "event_names": with_log("select name, count(*) as event_count from all_log group by 1"),
    "volume_overview": with_log(
        f"""select {fmt('count(*)')} as total_events,
          {fmt('count(distinct user_id)')} as unique_visitors_user_id,
          {fmt(f'count(distinct {prop("GPN")})')} as unique_persons_gpn,
          {fmt(f"count(distinct sha256('{PEPPER}' || {prop('GPN')}))")} as unique_persons_hash,
          {fmt('count(distinct session_id)')} as unique_sessions,
          {stamp(f'min({TS})')} as first_event, {stamp(f'max({TS})')} as last_event,
          count(distinct client_CountryOrRegion) as countries from log"""
    ),
    "distinct_people": with_log(
        f"""select {fmt('count(distinct user_id)')} as exact_user_id,
          {fmt(f'count(distinct {prop("GPN")})')} as exact_gpn,
          {fmt(f"count(distinct sha256('{PEPPER}' || {prop('GPN')}))")} as exact_hash,
          {rounded(f'1e0 * count(distinct user_id) / count(distinct {prop("GPN")})', 2)}
            as ratio_user_id_to_gpn from log"""
    ),
    "link_type_share": with_log(
        f"""select {prop('Link_Type')} as link_type, count(*) as event_count,
          count(distinct user_id) as unique_users, count(distinct session_id) as unique_sessions,
          {rounded('100e0 * count(*) / (select count(*) from log)', 2)} as pct from log group by 1"""
    ),
    "link_type_samples": with_log(
        f"""select {prop('Link_Type')} as link_type, count(*) as event_count,
          {sample(prop('Link_label'), 5)} as sample_labels from log group by 1"""
    ),
    "link_component_topk": with_log(
        f"""select {prop('Link_Type')} as link_type, {prop('ComponentName')} as component,
          count(*) as event_count from log group by 1, 2 order by 3 desc, 1, 2 limit 50"""
    ),
    "page_topk": with_log(
        f"""select {prop('PageURL')} as page_url, count(*) as event_count,
          count(distinct user_id) as unique_users from log group by 1 order by 2 desc, 1 limit 50"""
    ),
    "link_topk_certified": with_log(
        f"""select {prop('Link_Type')} as link_type, {prop('Link_address')} as address, count(*) as event_count
          from log group by 1, 2 order by 3 desc, 1, 2 limit 50"""
    ),
    "site_distribution": with_log(
        f"""select {prop('SiteName')} as site_name, count(*) as event_count,
          count(distinct user_id) as unique_users, count(distinct {prop('PageURL')}) as unique_pages
          from log group by 1"""
    ),
    "content_link_topk": with_log(
        f"""select {prop('ContentType')} as content_type, {prop('Link_Type')} as link_type,
          count(*) as event_count from log group by 1, 2 order by 3 desc, 1, 2 limit 50"""
    ),
    "link_domains": with_log(
        f"""select regexp_extract({prop('Link_address')}, 'https?://([^/]+)', 1) as domain,
          count(*) as event_count, count(distinct {prop('Link_address')}) as unique_links
          from log group by 1 order by 2 desc, 1 limit 30"""
    ),
    "file_types": with_log(
        f"""select {prop('FileType_Label')} as file_type, count(*) as event_count,
          count(distinct user_id) as unique_users, {sample(prop('FileName_Label'), 3)} as sample_files
          from log where {prop('FileType_Label')} <> '' group by 1"""
    ),
    "field_profile": with_log(
        f"""select {sample(prop('Video_Action'), 20)} as video_action_values,
          {sample(prop('Video_Type'), 20)} as video_type_values,
          {sample(prop('Video_Duration'), 10)} as video_duration_values,
          {sample(prop('Topic'), 30)} as topic_values, {sample(prop('Theme'), 30)} as theme_values,
          {sample(prop('TargetOrganisation'), 20)} as target_org_values,
          {sample(prop('TargetRegion'), 20)} as target_region_values,
          count(distinct {prop('Video_Id')}) filter ({prop('Video_Action')} <> '') as video_action_count,
          count(distinct {prop('Topic')}) as topic_distinct,
          count(distinct {prop('Theme')}) as theme_distinct,
          count(distinct {prop('TargetOrganisation')}) as target_org_distinct,
          count(distinct {prop('TargetRegion')}) as target_region_distinct, count(*) as total,
          count(*) filter ({prop('Video_Action')} <> '') as has_video,
          count(*) filter ({prop('Topic')} <> '') as has_topic,
          count(*) filter ({prop('Theme')} <> '') as has_theme,
          count(*) filter ({prop('TargetOrganisation')} <> '') as has_target_org,
          count(*) filter ({prop('TargetRegion')} <> '') as has_target_region,
          count(*) filter ({prop('refUri')} <> '') as has_ref_uri from log"""
    ),
    "key_inventory": with_log(
        """select key, count(*) as key_count, count(distinct value) as distinct_values,
          min(value) as sample_value
        from (select key, coalesce(json_extract_string(cp, '$."' || key || '"'), '') as value
          from (select cp, unnest(json_keys(cp)) as key from log where cp is not null)) group by 1"""
    ),
    "raw_sample": with_log(
        f"""select {stamp(TS)} as "timestamp", name, user_id as user_Id, session_id as session_Id,
          client_CountryOrRegion, coalesce(array_to_string(list_sort(list_transform(json_keys(cp),
            lambda k: k || '=' || coalesce(json_extract_string(cp, '$."' || k || '"'), ''))), '|'), '') as properties
          from log order by {TS}, 2, 3, 4, 5, details limit 10"""
    ),
    "flatten_props": with_log(
        f"""select strftime({TS}, '%d/%m/%Y %H:%M:%S.%f') || '0' as "timestamp [UTC]", {NAMED},
          {flat_columns('CP_')} from log"""
    ),
    "flatten_unprefixed": with_log(
        f"""select {stamp(TS)} as "timestamp", {NAMED}, {flat_columns('')} from log"""
    ),
    "anonymized_flat": with_log(
        f"""select {stamp(TS)} as "timestamp", {NAMED}, {flat_columns('CP_', ('Email', 'GPN', 'gpn'))},
          sha256('{PEPPER}' || {prop('GPN')}) as CP_GPN, sha256('{PEPPER}' || {prop('gpn')}) as CP_gpn_1 from log"""
    ),
    "email_filter": with_log(
        f"""select {stamp(TS)} as "timestamp", {NAMED}, {flat_columns('CP_')} from log
          where {prop('Email')} ilike '%user1%'"""
    ),
    "session_enriched": with_events(
        f"""select event_id, gpn, email, timestamp_str, {stamp('timestamp_cet')} as timestamp_cet,
          timestamp_cet_str, cast(session_date as varchar) as session_date, session_key, event_hour,
          event_weekday, event_weekday_num, cast(event_order as int) as event_order, prev_event,
          {stamp('prev_timestamp')} as prev_timestamp,
          cast(ms_since_prev_event as double) as ms_since_prev_event, sec_since_prev_event,
          time_since_prev_bucket from ev"""
    ),
    "hr_asof": with_events(f"select event_id, gpn, {', '.join(HR_PRESENT.values())} from org"),
    "asof_daily": """with told as (
        select o_custkey as user_id, timestamp '2024-01-01' + to_days(cast(o_orderkey % 30 as int)) as taken,
          o_orderkey as record, case when o_orderkey % 4 > 0 then o_orderpriority end as priority from orders),
      days as (
        select * from told qualify row_number() over (partition by user_id, taken order by record desc) = 1),
      known as (
        select *, coalesce(priority, lead(priority) over (partition by user_id order by taken)) as said from days),
      first_of as (select user_id, min_by(record, taken) as record, arg_min_null(priority, taken) as priority
        from days group by 1)
      select event_id, e.user_id, cast(coalesce(k.record, f.record) as double) as record,
        case when k.record is not null then k.said else f.priority end as priority
      from events e asof left join known k on e.user_id = k.user_id and e.ts >= k.taken
      left join first_of f on e.user_id = f.user_id""",
    "events_anonymized": with_events(
        f"""select event_id, {stamp(TS)} as "timestamp", name, user_id, session_id, client_CountryOrRegion,
          {", ".join(c for c in FLAT if c not in ("CP_GPN", "CP_Email"))}, {hmac('CP_GPN')} as CP_Person_Hash,
          {hmac('gpn')} as person_hash, timestamp_str, {stamp('timestamp_cet')} as timestamp_cet, timestamp_cet_str,
          session_date::varchar as session_date, session_key, event_hour, event_weekday, event_weekday_num,
          cast(event_order as int) as event_order, prev_event, {stamp('prev_timestamp')} as prev_timestamp,
          cast(ms_since_prev_event as double) as ms_since_prev_event, sec_since_prev_event,
          time_since_prev_bucket, {", ".join(HR_PRESENT.values())} from ev"""
    ),
    "date_formats": with_base(
        f"""select event_id, spelled, {stamp('parsed')} as parsed from (
        select event_id, case event_id % 14
          when 0 then strftime({TS}, '%d/%m/%Y %H:%M:%S.%f') || '7'
          when 1 then strftime({TS}, '%d/%m/%Y %H:%M:%S.%f')
          when 2 then strftime({TS}, '%d/%m/%Y %H:%M:%S.%g')
          when 3 then strftime({TS}, '%d/%m/%Y %H:%M:%S')
          when 4 then strftime({TS}, '%d/%m/%Y %H:%M')
          when 5 then strftime({TS}, '%d/%m/%Y')
          when 6 then strftime({TS}, '%d.%m.%Y %H:%M:%S')
          when 7 then strftime({TS}, '%d.%m.%Y %H:%M')
          when 8 then strftime({TS}, '%d.%m.%Y')
          when 9 then strftime({TS}, '%Y-%m-%d %H:%M:%S')
          when 10 then strftime({TS}, '%Y-%m-%d %H:%M:%S.%f')
          when 11 then strftime({TS}, '%Y-%m-%dT%H:%M:%S.%g')
          when 12 then strftime({TS}, '31/02/%Y %H:%M:%S')
          else 'soon' end as spelled,
        case when event_id % 14 in (0, 1, 10) then {TS}
          when event_id % 14 in (2, 11) then date_trunc('millisecond', {TS})
          when event_id % 14 in (3, 6, 9) then date_trunc('second', {TS})
          when event_id % 14 in (4, 7) then date_trunc('minute', {TS})
          when event_id % 14 in (5, 8) then date_trunc('day', {TS}) end as parsed
        from click_rows)"""
    ),
    "precision_check": with_base(
        f"""select count(*) as total, count(*) filter (epoch_us({TS}) % 1000000 <> 0) as with_fraction,
          cast(count(*) filter (epoch_us({TS}) % 1000000 <> 0) > 0 as varchar) as has_fraction
          from click_rows"""
    ),
    "local_time_sample": with_events(
        f"""select {stamp(TS)} as utc_timestamp, {stamp('timestamp_cet')} as cet_timestamp,
          cast(hour({TS}) as int) as utc_hour, event_hour as cet_hour,
          cast(session_date as varchar) as session_date
          from sess2 order by {TS}, session_key limit 3"""
    ),
    "upsert_overlap": with_base(
        f""", first_rows as (
          select {TS}, user_id, case when event_id % 31 > 0 then session_id end as session_id, name,
            event_id, 'first' as delivery from click_rows),
        second_rows as (select * replace ('second' as delivery) from first_rows
          where {TS} >= timestamp '2024-06-01'),
        third_rows as (select * replace ('third' as delivery) from first_rows
          where {TS} >= timestamp '2024-10-01'),
        after_second as (
          select * from first_rows f where not exists (select 1 from second_rows b
            where f."timestamp" = b."timestamp" and f.user_id = b.user_id
              and f.session_id = b.session_id and f.name = b.name)
          union all select * from second_rows),
        after_third as (
          select * from after_second f where not exists (select 1 from third_rows b
            where f."timestamp" = b."timestamp" and f.user_id = b.user_id
              and f.session_id = b.session_id and f.name = b.name)
          union all select * from third_rows)
        select {stamp(TS)} as "timestamp", user_id, session_id, name, event_id, delivery
        from after_third"""
    ),
    "video_actions": with_video("select action, count(*) as n from video group by 1"),
    "video_segments": with_video(
        f"""select {stamp(TS)} as "timestamp", gpn, session_id, video_id, action, prev_action,
          {rounded('time_delta', 6)} as time_delta, {rounded('timestamp_delta', 6)} as timestamp_delta,
          cast(is_valid_segment as varchar) as is_valid_segment,
          {rounded('watched_seconds', 6)} as watched_seconds, jump_type from seg"""
    ),
    "video_segment_totals": with_video(
        f"""select count(*) filter (is_valid_segment) as valid_segments,
          {rounded('coalesce(sum(watched_seconds) filter (is_valid_segment), 0)', 6)}
            as total_watch_seconds from seg"""
    ),
    "video_unique_seconds": with_video(
        f"""select gpn, video_id, session_id,
          {rounded('unique_seconds_watched', 6)} as unique_seconds_watched from uniq"""
    ),
    "video_unique_seconds_union": with_video(
        f"""select gpn, video_id, session_id,
          {rounded('union_seconds', 6)} as unique_seconds_watched from uniq"""
    ),
    "video_sessions": with_video(
        f"""select gpn, video_id, session_id, {rounded('watch_time', 6)} as watch_time,
          {rounded('max_position', 6)} as max_position, {stamp('session_start')} as session_start,
          {stamp('session_end')} as session_end, completed, pause_count, forward_skip_count,
          backward_skip_count, event_count,
          {rounded('unique_seconds_watched', 6)} as unique_seconds_watched from vsessions"""
    ),
    "video_views": with_video("select gpn, video_id, total_views from vviews"),
    "video_metadata": with_video(
        """select video_id, reported as reported_duration,
          if(newest.has_title, newest.title, null) as latest_title, newest.kind as latest_type,
          newest.address as latest_address from vmeta"""
    ),
    "video_engagement": with_video(
        "select * replace (cast(is_completed as varchar) as is_completed, "
        "cast(is_replay as varchar) as is_replay) from engaged"
    ),
    "engagement_summary": with_video(
        f"""select count(*) as combinations, count(distinct gpn) as unique_viewers,
          count(distinct video_id) as unique_videos, {rounded('avg(total_watch_time)', 1)} as avg_watch_time,
          {rounded('avg(watch_percentage) filter (is_completed)', 1)} as avg_completion_watch_pct,
          count(*) filter (is_completed) as completed_count,
          count(*) filter (data_quality_flag = 'completed_without_sufficient_watch') as gaming_count,
          count(*) filter (data_quality_flag <> 'ok') as flagged from engaged"""
    ),
    "tier_distribution": with_video(
        "select engagement_tier, count(*) as n from engaged group by 1"
    ),
    "dim_date": with_dims(
        """select date_key, cast(date_value as varchar) as date_value, cast(year(date_value) as int) as year,
          cast(quarter(date_value) as int) as quarter, cast(month(date_value) as int) as month,
          monthname(date_value) as month_name, cast(weekofyear(date_value) as int) as week,
          cast(isodow(date_value) as int) as day_of_week, dayname(date_value) as day_name,
          cast(isodow(date_value) in (6, 7) as varchar) as is_weekend from d_date"""
    ),
    "dim_organization": with_dims("select * from d_org"),
    # What holds from each snapshot on, and from before the first; periods of the same are one.
    "dim_organization_history": with_events(
        f"""{HISTORY} select version as org_version_key, gpn, valid_from::varchar as valid_from, valid_to::varchar as valid_to,
          (valid_to is null)::varchar as is_current, {HISTORY_FIELDS} from versions"""
    ),
    "event_org_version": with_events(
        f"""{HISTORY} select event_id, gpn, version::double as org_version_key from sess2 left join versions using (gpn)
        where version is null or (coalesce(valid_from <= "timestamp"::date, true) and coalesce("timestamp"::date <= valid_to, true))"""
    ),
    "dim_site": with_dims("select * from d_site"),
    "dim_page": with_dims("select * from d_page"),
    "dim_link_type": with_dims("select * from d_link"),
    "dim_component": with_dims("select * from d_comp"),
    "fact_event": with_dims(
        f"""select date_key, org_key, site_key, page_key, link_type_key, component_key, {FACT_COLUMNS}
        from {FACT_ROWS}
        left join d_date using (date_value) left join d_org using (org_hash)
        left join d_site using (site_id, site_name)
        left join d_page using (page_id, page_name, page_url, content_type, page_status)
        left join d_link using (link_type) left join d_comp using (component_name)"""
    ),
    "fact_incremental": with_events(
        f"""select cast(date_value as varchar) as date_value, org_hash, site_id, site_name, page_id, page_name, page_url,
          content_type, page_status, link_type, component_name, {FACT_COLUMNS} from {FACT_ROWS}"""
    ),
    # Keys of the first step are numbered in their order, those that only the second step brings come after them.
    "stable_keys": with_events(
        f"""select dim, array_to_string(parts, '|') as natural_key,
          row_number() over (partition by dim order by not kept, parts) as number, kept::varchar as kept
        from (
          select dim, parts, bool_or(session_date < date '{CUT}') as kept from (
            select session_date, unnest([
              {{'dim': 'date_key', 'parts': [session_date::varchar]}},
              {{'dim': 'org_key', 'parts': [org_hash, {", ".join(ORG_TEXTS)}]}},
              {{'dim': 'site_key', 'parts': [site_id, site_name]}},
              {{'dim': 'page_key', 'parts': [page_id, page_name, page_url, content_type, page_status]}},
              {{'dim': 'link_type_key', 'parts': [link_type]}},
              {{'dim': 'component_key', 'parts': [component_name]}}], recursive := true)
            from {FACT_ROWS}
          ) group by dim, parts)"""
    ),
    "data_overview": with_events(
        """select cast(min(session_date) as varchar) as first_date,
          cast(max(session_date) as varchar) as last_date, count(distinct session_date) as days,
          count(*) as total_events, count(distinct user_id) as unique_users,
          count(distinct session_key) as unique_sessions, count(distinct gpn) as unique_gpns from sess2"""
    ),
    "hr_profile": with_base(
        """select count(*) as snapshot_rows, count(distinct gpn) as gpns,
          count(distinct (snapshot_year, snapshot_month)) as snapshots from hr"""
    ),
    "hr_coverage": with_events(
        f"""select count(*) as total, count(hr_division) as with_hr_data, count(gpn) as with_gpn,
          count(*) filter (gpn = '00000000') as with_blank_gpn,
          {rounded('100e0 * count(gpn) / count(*)', 1)} as gpn_pct,
          {rounded('100e0 * count(hr_division) / count(*)', 1)} as hr_pct from org"""
    ),
    "top_divisions": with_events(
        """select hr_division, count(*) as cnt from org where hr_division is not null group by 1
          order by 2 desc, 1 limit 10"""
    ),
    "unmatched_people": with_events(
        """select gpn, count(*) as cnt from org where gpn is not null and hr_division is null group by 1
          order by 2 desc, 1 limit 15"""
    ),
    "field_coverage": coverage(),
    "share_by_name": share("name", "name"),
    "share_by_link_type": share("coalesce(CP_Link_Type, '(blank)')", "link_type"),
    "share_by_component": share("coalesce(CP_ComponentName, '(blank)')", "component", "limit 10"),
    "share_by_site": share("coalesce(CP_SiteName, '(blank)')", "site_name", "limit 10"),
}

# The estimated forms are reported beside the exact ones; every estimate must be within 5 %.
VISITORS = ("unique_visitors_user_id", "unique_persons_gpn", "unique_persons_hash", "unique_sessions")


def with_flags(sql: str, counts: tuple[str, ...]) -> str:
    return f"select *, {', '.join(f"'true' as {c}_close" for c in counts)} from ({sql})"


ORACLE["volume_overview_approx"] = with_flags(ORACLE["volume_overview"], VISITORS)
ORACLE["key_inventory_approx"] = with_flags(ORACLE["key_inventory"], ("distinct_values",))

ORACLE["ingest_delta"] = with_base(
    f"""{STORED} select {stamp("t")} as "timestamp", user_id, session_id, name, event_id, label, gpn, due,
      {stamp("seen")} as seen from stored"""
)
PART_NAME = "'export_' || part || '_{}.csv' as filename, count(*) as row_count"
ORACLE["manifest_report"] = with_base(
    f"""{STORED} select {PART_NAME.format(DATES["a"])}, '2024-01-31' as date_suffix,
      'new' as first_run, 'skipped' as second_run from file_a group by part
    union all select {PART_NAME.format(DATES["b"])}, '2024-02-29', 'new', 'changed' from next_b group by part
    union all select {PART_NAME.format(DATES["c"])}, '2024-03-31', 'skipped', 'new' from file_c group by part"""
)
# Values are counted as delivered, by both runs; days stopped being counted as such with the run that widened them.
ORACLE["column_kinds"] = with_base(
    f"""{STORED}, delivered as (
      select * from file_a union all select * from file_b union all select * from next_b union all select * from file_c),
    counts(name, filled, times, kind, declared) as (
      select 'timestamp', count(t), count(t), 'time', true from delivered
      union all select 'CP_Seen', count(seen), count(seen), 'time', false from delivered
      union all select 'CP_Due', count(due), count(*) filter (due <> 'Budget 2024'), 'text', false from delivered
      union all select 'CP_GPN', count(gpn), 0, 'text', false from delivered
      union all select 'CP_Link_label', count(label), 0, 'text', false from delivered
      union all select 'event_id', count(event_id), 0, 'text', false from delivered
      union all select 'name', count(name), 0, 'text', false from delivered
      union all select 'user_id', count(user_id), 0, 'text', false from delivered
      union all select 'session_id', count(session_id), 0, 'text', false from delivered
      union all select 'client_CountryOrRegion', count(*), 0, 'text', false from delivered)
    select name, kind, filled, times, declared::varchar as declared, 0::bigint as unusable,
      (name = 'CP_Due')::varchar as widened from counts"""
)
# Kept up over two deliveries it is what it is in one.
ORACLE["video_incremental"] = ORACLE["video_engagement"]
# The log's events as an export of them would bring them: an empty property is a missing one.
ORACLE["log_route"] = with_log(
    f"""select {stamp(TS)} as "timestamp", user_id, session_id, name, nullif({prop("Link_label")}, '') as label,
      nullif({prop("GPN")}, '') as gpn, nullif({prop("gpn")}, '') as other_gpn, nullif({prop("ContentOwner")}, '') as owner
    from log"""
)
ORACLE["log_streamed"] = ORACLE["log_route"]
ORACLE["daily_trend_stored"] = ORACLE["daily_trend_90d"]
RANGE = f"{TS} >= timestamp '{FROM}' and {TS} < timestamp '{TO}' + interval 1 day"
ORACLE["visits_sketched"] = with_log(
    f"""select count(*) as total_events, {stamp(f"min({TS})")} as first_event, {stamp(f"max({TS})")} as last_event,
      count(distinct user_id) as n_users, count(distinct session_id) as n_sessions,
      count(distinct {prop("GPN")}) as n_gpns, count(distinct client_CountryOrRegion) as n_countries,
      'true' as users_close, 'true' as sessions_close, 'true' as gpns_close, 'true' as countries_close
    from log where {RANGE}"""
)
ORACLE["property_values_sketched"] = with_log(
    f"""select key, count(*) as key_count, min(value) as sample_value, count(distinct value) as distinct_values, 'true' as "close"
    from (
      select unnest(json_keys(cp)) as key, coalesce(json_extract_string(cp, '$.' || unnest(json_keys(cp))), '') as value
      from log where cp is not null and {RANGE}
    ) group by key"""
)
# Other ways to the same rows.
ORACLE["page_topk_certified"] = ORACLE["page_topk"]
ORACLE["hr_asof_carried"] = ORACLE["hr_asof"]
