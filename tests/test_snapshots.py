"""Snapshot tables: one version for readers, conflicts for writers, nothing left of crashed loads."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import tables
from tidemark.sources.snapshots import Conflict, SnapshotTable

NOW = "2024-03-01 00:00:00"
SERIES = ("A", "001", "a b+c%d/e=f", "ö", "__HIVE__", "x'y")


def batch(spark, rows):
    return spark.createDataFrame([(s, d, v, "u") for s, d, v in rows], "series_id string, d string, value double, source_url string").selectExpr(
        "series_id", "date(d) as observation_date", "value", "source_url")


def content(df):
    return sorted((r.series_id, str(r.observation_date), r.value) for r in df.collect())


def folders(path):
    return sorted(os.listdir(os.path.join(path, "data")))


def test_upsert_replaces_touched_partitions_only(spark, workdir):
    path = os.path.join(workdir, "obs")
    first = [(s, f"{y}-01-01", float(y)) for s in SERIES for y in (2020, 2021)]
    assert tables.upsert_table(spark, path, batch(spark, first), now=NOW) == 12
    table = tables.observations_table(spark, path)
    before = {(r.series_id, r.obs_year): (r._folder, r._rows) for r in table.manifest().collect()}
    assert content(table.read()) == sorted(first) and len(before) == 12
    assert table.read().columns == ["series_id", "observation_date", "value", "ingested_at", "source_url"]
    tables.upsert_table(spark, path, batch(spark, [("001", "2021-01-01", -1.0), ("001", "2021-06-01", 5.0), ("new", "2022-01-01", 0.0)]), now=NOW)
    after = {(r.series_id, r.obs_year): (r._folder, r._rows) for r in table.manifest().collect()}
    assert {k for k in after if after[k] != before.get(k)} == {("001", 2021), ("new", 2022)} and after["001", 2021][1] == 2
    want = sorted([r for r in first if r[:2] != ("001", "2021-01-01")] + [("001", "2021-01-01", -1.0), ("001", "2021-06-01", 5.0), ("new", "2022-01-01", 0.0)])
    assert content(table.read()) == want
    # a replay of the same batch gives the same rows
    tables.upsert_table(spark, path, batch(spark, [("001", "2021-01-01", -1.0), ("001", "2021-06-01", 5.0), ("new", "2022-01-01", 0.0)]), now=NOW)
    assert content(table.read()) == want and table.version() == 3


def test_touched_reads_open_only_their_folders(spark, workdir):
    path = os.path.join(workdir, "obs")
    tables.upsert_table(spark, path, batch(spark, [(s, "2020-01-01", 1.0) for s in SERIES]), now=NOW)
    table = tables.observations_table(spark, path)
    some = spark.createDataFrame([("A", 2020), ("ö", 2020), ("A", 1999)], "series_id string, obs_year int")
    got = table.read(some)
    assert content(got) == [("A", "2020-01-01", 1.0), ("ö", "2020-01-01", 1.0)] and len(got.inputFiles()) == 2


def test_open_reader_keeps_its_version(spark, workdir):
    path = os.path.join(workdir, "obs")
    rows = [(s, "2020-01-01", 1.0) for s in SERIES]
    tables.upsert_table(spark, path, batch(spark, rows), now=NOW)
    old = tables.read_observations(spark, path)                 # opened, not read yet
    tables.upsert_table(spark, path, batch(spark, [(s, "2020-01-01", 2.0) for s in SERIES]), now=NOW)
    assert {v for *_, v in content(old)} == {1.0} and len(content(old)) == len(SERIES)
    assert {v for *_, v in content(tables.read_observations(spark, path))} == {2.0}


def test_overtaken_writer_fails_and_changes_nothing(spark, workdir):
    path = os.path.join(workdir, "obs")
    tables.upsert_table(spark, path, batch(spark, [("A", "2020-01-01", 1.0)]), now=NOW)
    table = tables.observations_table(spark, path)
    base = table.version()
    mine = table.read(version=base).withColumn("value", F.lit(7.0))
    tables.upsert_table(spark, path, batch(spark, [("B", "2020-01-01", 2.0)]), now=NOW)  # the other load
    with pytest.raises(Conflict):
        table.replace(mine, table.values(mine), base)
    want = [("A", "2020-01-01", 1.0), ("B", "2020-01-01", 2.0)]
    assert content(table.read()) == want
    # both writers pass the first look: the file system decides
    name = table._manifest_name(table.version())
    with pytest.raises(Conflict):
        table._commit(name, table.version())
    assert content(table.read()) == want and not [n for n in os.listdir(os.path.join(path, "_commits")) if n.startswith("_fresh")]
    with pytest.raises(Conflict):
        table.replace(mine, None, None)                        # a first load beside an existing table
    assert table.vacuum(older_than_s=3600) == 0
    assert table.vacuum(older_than_s=-1) >= 2 and content(table.read()) == want


def test_crashed_first_load_is_no_table(spark, workdir):
    path = os.path.join(workdir, "obs")
    table = tables.observations_table(spark, path)
    crashed = batch(spark, [("A", "2020-01-01", 1.0)])
    crashed.write.parquet(os.path.join(path, "data", "half"))
    assert not tables.has_observations(spark, path) and table.read().collect() == []
    tables.upsert_table(spark, path, batch(spark, [("B", "2020-01-01", 2.0)]), now=NOW)
    assert content(table.read()) == [("B", "2020-01-01", 2.0)]
    assert table.vacuum(older_than_s=-1) == 1 and folders(path) != [] and content(table.read()) == [("B", "2020-01-01", 2.0)]


def test_replaced_folders_go_after_the_kept_versions(spark, workdir):
    path = os.path.join(workdir, "obs")
    for v in range(1, 5):
        tables.upsert_table(spark, path, batch(spark, [("A", "2020-01-01", float(v)), ("B", f"{2000 + v}-01-01", 0.0)]), now=NOW)
    table = tables.observations_table(spark, path)
    assert table.versions() == [3, 4] and content(table.read(version=3))[0] == ("A", "2020-01-01", 3.0)
    assert content(table.read()) == [("A", "2020-01-01", 4.0)] + [("B", f"{2000 + v}-01-01", 0.0) for v in range(1, 5)]
    a = [d for d in folders(path) if os.path.exists(os.path.join(path, "data", d, "_p_series_id=A", "_p_obs_year=2020"))]
    assert len(a) == 2 and len(os.listdir(os.path.join(path, "_manifests"))) == 2


def test_partitions_that_become_empty_go_and_nulls_stay_apart(spark, workdir):
    schema = spark.createDataFrame([], "k string, v int").schema
    table = SnapshotTable(spark, os.path.join(workdir, "t"), schema, {"k": "k"})
    table.replace(spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], schema))
    gone = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(r.v for r in table.read(gone).collect()) == [1, 2]
    table.replace(spark.createDataFrame([(None, 5)], schema), gone, 1)
    assert sorted((r.v, r.k) for r in table.read().collect()) == [(3, "b"), (5, None)]
    written = table.replace(spark.createDataFrame([], schema), None, 2)
    assert table.read().collect() == [] and written.collect() == []
