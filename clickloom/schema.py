"""Column spellings of click exports and the lookup that maps them to logical fields."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Accepted spellings per logical field, in order of preference.
SPELLINGS: dict[str, tuple[str, ...]] = {
    "gpn": ("CP_GPN", "CP_gpn", "GPN", "gpn"),
    "email": ("Email", "email", "CP_Email", "CP_email"),
    "site_id": ("CP_SiteID", "CP_siteID", "CP_SiteId"),
    "site_name": ("CP_SiteName", "CP_siteName"),
    "page_id": ("CP_PageId", "CP_pageId", "CP_PageID"),
    "page_name": ("CP_PageName", "CP_pageName"),
    "page_url": ("CP_PageURL", "CP_pageURL", "CP_PageUrl"),
    "content_type": ("CP_ContentType", "CP_contentType"),
    "page_status": ("CP_PageStatus", "CP_pageStatus"),
    "link_type": ("CP_Link_Type", "CP_link_type", "CP_LinkType"),
    "component": ("CP_ComponentName", "CP_componentName"),
    "link_address": ("CP_Link_address", "CP_link_address"),
    "link_label": ("CP_Link_label", "CP_link_label"),
    "file_name": ("CP_FileName_Label", "CP_fileName_Label"),
    "file_type": ("CP_FileType_Label", "CP_fileType_Label"),
    "client_country": (
        "client_CountryOrRegion",
        "client_countryOrRegion",
        "client_countryorregion",
    ),
    "video_action": ("CP_Video_Action", "CP_video_Action", "CP_video_action"),
    "video_id": ("CP_Video_Id", "CP_video_Id", "CP_video_id", "CP_Video_ID"),
    "video_title": ("CP_Video_Title", "CP_video_Title", "CP_video_title"),
    "video_duration": ("CP_Video_Duration", "CP_video_Duration", "CP_video_duration"),
    "video_position": ("CP_Video_PlayedTime", "CP_video_PlayedTime", "CP_video_playedTime"),
    "video_type": ("CP_Video_Type", "CP_video_Type", "CP_video_type"),
    "video_address": ("CP_Video_Address", "CP_video_Address", "CP_video_address"),
}

# Organisation snapshot field -> name on the enriched event.
HR_FIELDS: dict[str, str] = {
    "gcrs_division_desc": "hr_division",
    "gcrs_unit_desc": "hr_unit",
    "gcrs_area_desc": "hr_area",
    "gcrs_sector_desc": "hr_sector",
    "gcrs_segment_desc": "hr_segment",
    "gcrs_function_desc": "hr_function",
    "ou_code": "hr_ou_code",
    "work_location_country": "hr_country",
    "work_location_region": "hr_region",
    "job_title": "hr_job_title",
    "job_family": "hr_job_family",
    "management_level": "hr_management_level",
    "cost_center": "hr_cost_center",
}

# Export header -> stored column.
EXPORT_RENAMES = {"user_Id": "user_id", "session_Id": "session_id", "timestamp [UTC]": "timestamp"}

EVENT_KEY = ("timestamp", "user_id", "session_id", "name")


# Columns of keys that differ in case alone are told apart by a number at the end.
NUMBERED = re.compile(r"_\d+$")


def spellings_in(columns: Iterable[str], field: str) -> list[str]:
    """Columns that carry ``field``, most preferred first; names compare without case, numbered ones come last."""
    wanted = list(dict.fromkeys(spelling.lower() for spelling in SPELLINGS[field]))
    plain = {name.lower(): name for name in columns}
    numbered = [name for name in plain if name not in wanted and NUMBERED.sub("", name) in wanted]
    numbered.sort(key=lambda name: (wanted.index(NUMBERED.sub("", name)), name))
    return [plain[name] for name in [*wanted, *numbered] if name in plain]


def resolve(columns: Iterable[str], field: str) -> str | None:
    found = spellings_in(columns, field)
    return found[0] if found else None


def quoted(name: str) -> Column:
    """Column by literal name, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def optional(columns: Iterable[str], field: str, data_type: str = "string") -> Column:
    """The field's column cast to ``data_type`` (NULL where that fails), or a typed NULL."""
    name = resolve(columns, field)
    return quoted(name).try_cast(data_type) if name else F.lit(None).cast(data_type)
