"""What the video metrics kept up over deliveries read."""

from __future__ import annotations

import shutil
import tempfile

from conftest import SMALL
from oracle import maintained


def test_engagement_reads_no_organisation(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    shutil.copy(f"{SMALL}/events.parquet", folder)  # no snapshots beside the events
    assert maintained.engagement(spark, folder).count() > 0
