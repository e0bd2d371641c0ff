"""Near-duplicates that only a crowded bucket can bring together."""

from __future__ import annotations

import numpy as np
import pytest

from clickloom.llm import near_dups
from test_whole_tables import components, linked, shingles


@pytest.mark.parametrize("crowd", [8])
def test_pairs_in_crowded_buckets(spark, monkeypatch, crowd):
    """Texts of one template, each with a partner at the limit that nothing else binds to it."""
    monkeypatch.setattr(near_dups, "CROWD", crowd)
    rng = np.random.default_rng(5)
    texts = []
    for i in range(130):
        own = [f"w{j}" for j in range(120)]
        edits = rng.permutation(np.arange(3, 117, 6))[:6]
        for at in edits[:3]:
            own[at] = f"x{i}y{at}"
        texts.append(" ".join(own))
        for at in edits[3:]:
            own[at] = f"z{i}y{at}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    root = components(linked(sets), sets)
    assert len(set(root.values())) > 100
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert got == root


def test_stars_take_no_rounds(spark, monkeypatch):
    """Edges that are stars already are told by one look, not by a round that changes nothing."""
    from clickloom.llm import components as tabled

    written = []
    monkeypatch.setattr(tabled, "materialize", lambda df, label, real=tabled.materialize: written.append(label) or real(df, label))
    pairs = [(0, i) for i in range(1, 9)] + [(20, 21), (30, 31)]
    got = {r["node"]: r["root"] for r in tabled.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 9)} | {21: 20, 31: 30}
    assert written == ["edges"]


def test_rows_for_the_driver_take_few_jobs(spark):
    """A filter comes to the driver in a few jobs, not in one for each of the shuffle's partitions."""
    from clickloom.llm import bloom

    hashes = spark.range(5000).selectExpr("xxhash64(id) as h").repartition(3)
    every = np.array([r["h"] for r in hashes.collect()], np.int64).view(np.uint64)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("few-jobs", "a filter for the driver")
    try:
        bits = bloom.unpacked(bloom.filter_of(hashes, 4))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert bloom.found(bits, bloom.positions(every, 4)).all()
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) < 20
