"""What the jobs shuffle and write: hash keys, raw files, links and satellites."""

from __future__ import annotations

import time
from datetime import datetime
from pathlib import Path

import pytest
from conftest import plan, tuples

from vaultwright.functions import hash_key
from vaultwright.loading import motorsport as m
from vaultwright.loading import vault as vault_module
from vaultwright.loading.vault import Vault
from vaultwright.operators import build, newrows
from vaultwright.session import shared_folder
from vaultwright.sources import csv
from vaultwright.sources.store import FolderStore
from vaultwright.spec import BATCH_ID, FEED, LONG, TEXT, HubSpec, LinkSpec, SatSpec, columns

TS = datetime(2024, 1, 1)
PAIR = LinkSpec("PAIR", {"A": "a", "B": "b"})
ORDERED = LinkSpec("PAIR", {"A": "a", "B": "b"}, order=("b", "a"))
HUB = HubSpec("THING", "id")


@pytest.fixture
def vault(spark, tmp_path):
    return Vault(FolderStore(spark, str(tmp_path / "vault")))


def test_stored_hash_keys_take_little_more_than_their_bytes(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    rows = spark.range(0, 50_000, 1, 1).select(hash_key("id").alias("HK"))
    store.replace_batch("HUB", rows, "001", "x")
    store.replace_batch("HUB", rows, "002", "x")
    files = [p for p in tmp_path.rglob("*.parquet")]
    assert max(p.stat().st_size for p in files) < 20 * 50_000  # 16 bytes each, 32 as text
    store.compact("HUB", "002")
    assert sum(p.stat().st_size for p in (tmp_path / "HUB" / "merged").rglob("*.parquet")) < 20 * 100_000
    assert tuples(store.read_table("HUB").select("HK").distinct().agg({"HK": "count"})) == [(50_000,)]


def test_raw_files_are_compressed_and_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv, "FILE_ROWS", 4)
    rows = spark.createDataFrame([(n, f'a "{n}",\nb') for n in range(10)], "id long, name string").coalesce(1)
    csv.write_csv(rows, str(tmp_path / "raw"))
    assert len([p for p in Path(tmp_path / "raw").iterdir() if p.name.endswith(".csv.gz")]) == 3
    read = csv.read_csv(spark, str(tmp_path / "raw"), columns(id=LONG, name=TEXT), multi_line=True, report=True)
    assert tuples(read, "id", "name") == tuples(rows)
    assert read.where(f"{csv.RAW_LINE} IS NOT NULL").count() == 0


def test_ordered_link_takes_one_shuffle(spark):
    staged = spark.range(0, 4000, 1, 8).selectExpr("id * 7919 % 500 AS a", "id * 104729 % 40 AS b")
    staged = staged.union(spark.createDataFrame([(None, 1), (1, None)], "a long, b long"))
    rows = build.link_rows(staged, ORDERED, "x", TS)
    assert plan(rows).count("Exchange") == 1
    assert tuples(rows) == tuples(build.link_rows(staged, PAIR, "x", TS))
    keys = {r["HK"]: r["b"] for r in spark.range(40).select(hash_key("id").alias("HK"), "id").toDF("HK", "b").collect()}
    for part in rows.rdd.map(lambda r: r["B_HK"]).glom().collect():
        assert [keys[hk] for hk in part] == sorted(keys[hk] for hk in part)


def test_many_rows_of_an_ordered_link_are_dealt_out_by_their_number(spark, monkeypatch):
    staged = spark.range(0, 4000, 1, 8).selectExpr("id * 7919 % 500 AS a", "id * 104729 % 40 AS b")
    monkeypatch.setattr(build, "RANGE_ROWS", 300)
    rows = build.link_rows(staged, ORDERED, "x", TS, rows=4000)
    assert rows.rdd.getNumPartitions() == 14 and tuples(rows) == tuples(build.link_rows(staged, PAIR, "x", TS))
    monkeypatch.setattr(build, "RANGE_ROWS", 1000)  # four cores: Spark's own number
    assert "REPARTITION_BY_NUM" not in plan(build.link_rows(staged, ORDERED, "x", TS, rows=4000))


def test_ordered_link_with_rows_stored(spark, vault, batches):
    first = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a long, b long")
    second = first.union(spark.createDataFrame([(2, 1), (2, 1)], "a long, b long"))
    for batch, staged in zip(batches, (first, second), strict=False):
        vault.load_link(staged, ORDERED, "x", batch)
    hk = lambda staged: {r["PAIR_HK"] for r in build.link_rows(staged, PAIR, "x", TS).collect()}
    stored = vault.read(ORDERED, first)
    assert sorted(r["PAIR_HK"] for r in stored.collect()) == sorted(hk(second))
    assert {r["PAIR_HK"] for r in stored.where(f"{BATCH_ID} = '{batches[1].id}'").collect()} == hk(second) - hk(first)


def _run(spark, vault, job, rows, batch):
    return m.run_job(vault, job, spark.createDataFrame(rows, job.stage.schema), batch)


def test_satellite_asks_its_link_whether_parents_repeat(spark, vault, batches, monkeypatch):
    job = m.JOBS["status"]
    link_job = m.Job(job.stage, (), (LinkSpec("S", {"STATUS": "STATUSID"}),), (SatSpec("SAT_S", LinkSpec("S", {"STATUS": "STATUSID"}), ("STATUS",)),))
    counted, by_count = [], build._versions_by_count
    monkeypatch.setattr(build, "_versions_by_count", lambda *a: counted.append(a) or by_count(*a))
    for job, sat, table in ((job, "SAT_STATUS", "HUB_STATUS"), (link_job, "SAT_S", "LNK_S")):
        _run(spark, vault, job, [(1, "a"), (2, "b"), (None, "c")], batches[0])
        assert not counted
        assert tuples(vault.store.read_table(sat), "STATUS") == [("A",), ("B",)]
        _run(spark, vault, job, [(1, "a"), (2, "c"), (3, "d"), (3, "d"), (3, "e")], batches[1])
        assert tuples(vault.store.read_table(sat), "STATUS") == [("A",), ("B",), ("C",), ("D",), ("E",)]
        assert vault.store.read_table(table).count() == 3
        counted.clear()


def test_repeated_parents_of_a_first_load_are_made_unique(spark, vault, batches):
    _run(spark, vault, m.JOBS["status"], [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (None, "c")], batches[0])
    assert tuples(vault.store.read_table("SAT_STATUS"), "STATUS") == [("A",), ("B",), ("B",)]
    assert vault.store.read_table("HUB_STATUS").count() == 2


def test_keys_of_a_first_feed_are_made_unique_once(spark, vault, batches, monkeypatch):
    built, from_feeds = [], build.hub_rows_from_feeds
    monkeypatch.setattr(vault_module, "hub_rows_from_feeds", lambda *a, **b: built.append(a) or from_feeds(*a, **b))
    load = lambda keys, feed, batch: vault.load_hub(
        [(spark.createDataFrame([(k,) for k in keys], "id long"), HUB, feed)], batch, shared=True)
    load([1, 2, 2, None], "a", batches[0])
    load([2, 3, 3], "b", batches[0])
    load([2, 3, 3], "b", batches[0])  # tried again
    assert not built
    load([1, 4, 4], "a", batches[1])
    assert built
    stored = vault.store.read_table("HUB_THING")
    assert tuples(stored, "THING_BK", "THING_HK", "RECORD_SOURCE", FEED, BATCH_ID) == sorted(
        (str(k), spark.range(k, k + 1).select(hash_key("id")).first()[0], feed.upper(), feed, batch.id)
        for k, feed, batch in ((1, "a", batches[0]), (2, "a", batches[0]), (3, "b", batches[0]), (4, "a", batches[1])))


def test_hash_keys_of_both_sides_are_shuffled_as_bytes(spark, conf, tmp_path):
    spark.range(5).select(hash_key("id").alias("THING_HK"), "id").write.parquet(str(tmp_path / "batch"))
    spark.range(3).select(hash_key("id").alias("THING_HK")).write.parquet(str(tmp_path / "target"))
    batch, target = (spark.read.parquet(str(tmp_path / name)) for name in ("batch", "target"))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = newrows.new_rows(batch, target, HUB.match, packed=True)
    assert plan(rows).count("Project [unhex(") == 2
    assert rows.columns == batch.columns and tuples(rows) == tuples(batch.where("id > 2"))


def test_circuits_of_constructors_lie_together(spark, vault, batches):
    races = [(r, 2024, 1, 1 + r % 20, "n", "2024-01-01", "00:00:00", "u") for r in range(200)]
    results = [(n, n % 200, 1, 1 + n * 7 % 30, *[1] * 3, "1", 1, 1.0, 1, None, *[None] * 3, None, None, 1) for n in range(3000)]
    vault.stage(spark.createDataFrame(races, m.RACES.schema), m.RACES, ["RACEID", "CIRCUITID"])
    vault.stage(spark.createDataFrame(results, m.RESULTS.schema), m.RESULTS, ["RACEID", "CONSTRUCTORID"])
    m.load_circuits_constructor(vault, batches[0])
    stored = vault.store.read_table("LNK_CIRCUITS_CONSTRUCTOR")
    pairs = {(1 + n % 200 % 20, 1 + n * 7 % 30) for n in range(3000)}
    assert stored.count() == stored.select("CIRCUIT_CONSTRUCTOR_HK").distinct().count() == len(pairs)
    for part in stored.rdd.map(lambda r: r["CIRCUIT_HK"]).glom().collect():
        assert sum(a != b for a, b in zip(part, part[1:], strict=False)) == max(len(set(part)) - 1, 0)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(n).getName() for n in range(files.size()) if files.apply(n).getName().startswith("shuffle_")}


def test_what_a_job_shuffled_goes_with_each_load(spark, vault, batches):
    setting, there = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", _shuffle_files(spark)
    before = spark.conf.get(setting, None)
    _run(spark, vault, m.JOBS["races"], [(r, 2024, 1, 1 + r % 20, "n", "2024-01-01", "00:00:00", "u") for r in range(200)], batches[0])
    deadline = time.time() + 20
    while (left := _shuffle_files(spark) - there) and time.time() < deadline:  # files go a moment later
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(setting, None) == before
    with pytest.raises(ValueError), m.shuffles_released(spark):
        raise ValueError
    assert spark.conf.get(setting, None) == before


def test_scratch_copies_of_raw_files_go_once_they_are_read(spark, tmp_path, vault, batches):
    rows = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "statusId string, status string")
    for path in (tmp_path / "status.csv", tmp_path / "seasons.csv"):
        csv.write_csv(rows if path.stem == "status" else rows.toDF("year", "url"), str(path))
    m.run_files(spark, vault, str(tmp_path), batches[0], ["status", "seasons"])
    m.run_files(spark, vault, str(tmp_path), batches[0], ["status", "seasons"], discard=True)
    assert not (tmp_path / "status.csv").exists() and not (tmp_path / "seasons.csv").exists()
    assert tuples(vault.store.read_table("SAT_STATUS"), "STATUS") == [("A",)]
    rejected = vault.store.read_table("REJECTED_STATUS")
    assert tuples(rejected, "STATUS", csv.RAW_LINE) == [("C", None), (None, "x,b")]


def test_feeds_of_a_hub_hold_no_hash_keys(spark, vault, batches):
    load = lambda keys, feed, batch, kind="long": vault.load_hub(
        [(spark.createDataFrame([(k,) for k in keys], f"id {kind}"), HUB, feed)], batch, shared=True)
    load([1, 2, 7], "a", batches[0])
    load(["2", "007", "x"], "b", batches[0], "string")
    load([2, 7, 8], "c", batches[1])
    load([2, 7, 8, 9, 9], "c", batches[2])
    assert "THING_HK" not in vault.store.read_table("FEEDS_HUB_THING").columns
    held = lambda: tuples(vault.store.read_table("HUB_THING"), "THING_BK", FEED)
    assert held() == sorted([("1", "a"), ("2", "a"), ("7", "a"), ("007", "b"), ("x", "b"), ("8", "c"), ("9", "c")])
    vault.refresh = True
    load([1], "a", batches[3])
    assert held() == sorted([("1", "a"), ("2", "b"), ("007", "b"), ("x", "b"), ("7", "c"), ("8", "c"), ("9", "c")])
    for hk, bk in tuples(vault.store.read_table("HUB_THING"), "THING_HK", "THING_BK"):
        assert hk == spark.createDataFrame([(bk,)], "id string").select(hash_key("id")).first()[0]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_numbers_are_compared_as_numbers(spark, vault, conf, batches, monkeypatch, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    stored = spark.createDataFrame([("3",), ("04",), ("-5",), ("x",), ("99999999999",)], "id string")
    vault.load_hub([(stored, HUB, "a")], batches[0])
    written, replace = [], vault.store.replace_batch
    monkeypatch.setattr(vault.store, "replace_batch", lambda table, rows, *a: written.append(plan(rows)) or replace(table, rows, *a))
    vault.load_hub([(spark.createDataFrame([(k,) for k in (3, 3, 4, -5, 6, None)], "id int"), HUB, "b")], batches[1])
    assert tuples(vault.store.read_table("HUB_THING").where(f"{FEED} = 'b'"), "THING_BK") == [("4",), ("6",)]
    if threshold == "-1":  # the keys stay where they were made unique; no hash is shuffled
        assert written[0].count("Exchange") == 2 and "unhex" not in written[0].split("Exchange", 1)[1]


def test_races_are_not_broadcast_by_the_size_of_their_files(spark, conf, vault, batches, monkeypatch):
    races = [(r, 2024, 1, 1 + r % 20, "n", "2024-01-01", "00:00:00", "u") for r in range(3000)]
    results = [(n, n, 1, 1 + n % 30, *[1] * 3, "1", 1, 1.0, 1, None, *[None] * 3, None, None, 1) for n in range(3000)]
    vault.stage(spark.createDataFrame(races, m.RACES.schema), m.RACES, ["RACEID", "CIRCUITID"])
    vault.stage(spark.createDataFrame(results, m.RESULTS.schema), m.RESULTS, ["RACEID", "CONSTRUCTORID"])
    plans, apart = [], vault.store.written_apart
    monkeypatch.setattr(vault.store, "written_apart", lambda rows, label: plans.append(plan(rows)) or apart(rows, label))
    for threshold in ("200KB", "10MB"):  # the files take less than either, the rows more than the first
        conf("spark.sql.autoBroadcastJoinThreshold", threshold)
        m.load_circuits_constructor(vault, batches[0])
        assert vault.store.read_table("LNK_CIRCUITS_CONSTRUCTOR").count() == 60
    assert "BroadcastHashJoin" not in plans[0] and "BroadcastHashJoin" in plans[1]
    assert not [p for p in Path(shared_folder(spark)).iterdir() if p.name.startswith("pairs-")]


def test_repeated_hash_keys_are_stored_once(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    rows = spark.range(0, 200_000, 1, 1).selectExpr("pmod(xxhash64(id), 40000) AS id").select(hash_key("id").alias("HK"))
    store.replace_batch("LNK", rows, "001", "x")
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 8 * 200_000  # 17 bytes each, unless once for five
