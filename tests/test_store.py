"""Files, stored tables and loads into them."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from conftest import plan, tuples
from pyspark.errors import AnalysisException

from vaultwright.loading.vault import Vault
from vaultwright.operators.report import inventory
from vaultwright.session import scratch_path, shared_folder
from vaultwright.sources.csv import read_csv
from vaultwright.sources.store import BucketedStore, FolderStore
from vaultwright.spec import INT, PASS_NULLS, REAL, STANDARD, TEXT, Batch, HubSpec, LinkSpec, SatSpec, StageSpec, columns

HUB = HubSpec("THING", "id")
LINK = LinkSpec("PAIR", {"THING": "id", "OTHER": "other"})
SAT = SatSpec("SAT_THING", HUB, ("name",))
SCHEMA = HUB.schema(columns(id=INT))


def things(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, other int, name string")


@pytest.fixture(params=["folder", "bucketed"])
def vault(request, spark, tmp_path):
    root = str(tmp_path / "vault")
    if request.param == "folder":
        yield Vault(FolderStore(spark, root))
        return
    spark.sql("CREATE DATABASE vault_test")
    yield Vault(BucketedStore(spark, root, buckets=4, database="vault_test"))
    spark.sql("DROP DATABASE vault_test CASCADE")


def hub_keys(vault, staged):
    return tuples(vault.read(HUB, staged), "THING_BK", "BATCH_ID")


def test_batches_and_retry(spark, vault, batches):
    first, second = things(spark, (1, 1, "a"), (2, 1, "b"), (2, 1, "b")), things(spark, (2, 1, "b"), (3, 1, "c"))
    assert vault.load_hub([(first, HUB, "x.csv")], batches[0]).mode == "initial"
    assert vault.load_hub([(second, HUB, "x.csv")], batches[1]).mode == "incremental"
    expected = [("1", "001"), ("2", "001"), ("3", "002")]
    assert hub_keys(vault, first) == expected
    # retries of either batch, and a batch without news
    vault.load_hub([(second, HUB, "x.csv")], batches[1])
    vault.load_hub([(first, HUB, "x.csv")], batches[0])
    vault.load_hub([(first, HUB, "x.csv")], batches[2])
    assert hub_keys(vault, first) == expected


def test_retry_replaces_what_the_first_try_wrote(spark, vault, batches):
    vault.load_hub([(things(spark, (1, 1, "a"), (2, 1, "b")), HUB, "x.csv")], batches[0])
    empty = things(spark, (1, 1, "a")).limit(0)
    vault.load_hub([(empty, HUB, "x.csv")], batches[0])
    assert hub_keys(vault, empty) == []


def test_feed_names_with_any_characters(spark, vault, batches):
    """Names that would collide as folder names stay apart, also on a retry."""
    staged = things(spark, (1, 1, "a"))
    names = ["a b/c.csv", "a_b_c.csv", "it's=100%\\"]
    for number, name in enumerate([*names, *names]):
        vault.load_hub([(things(spark, (number % 3, 1, "x")), HUB, name)], batches[0])
    stored = vault.read(HUB, staged)
    assert tuples(stored, "THING_BK", "FEED") == [(str(n), name) for n, name in enumerate(names)]
    with pytest.raises(ValueError):
        vault.load_hub([(staged, HUB, "")], batches[0])


def test_facts_with_few_keys_take_the_broadcast_form(spark, conf, tmp_path, batches):
    """Many rows with few keys against a larger hub: the keys are counted."""
    conf("spark.sql.autoBroadcastJoinThreshold", "10KB")
    vault = Vault(FolderStore(spark, str(tmp_path)))
    vault.load_hub([(spark.range(3000), HUB, "x.csv")], batches[0])
    facts = spark.range(2000).selectExpr("2995 + id % 10 AS id")
    vault.load_hub([(facts, HUB, "y.csv")], batches[1])
    stored = vault.read(HUB, facts).where("BATCH_ID = '002'")
    assert tuples(stored, "THING_BK") == [(str(k),) for k in range(3000, 3005)]


@pytest.mark.parametrize("threshold", ["10MB", "20KB", "-1"])
@pytest.mark.parametrize(
    "policy, history, rule",
    [
        ("hash_diff", "any", STANDARD), ("hash_diff", "any", PASS_NULLS), ("hash_diff", "latest", STANDARD),
        ("hash_diff", "latest", PASS_NULLS), ("key", "any", STANDARD),
    ],
)
def test_every_way_to_find_new_versions_agrees(spark, conf, tmp_path, batches, policy, rule, threshold, history):
    """All broadcast, only the new versions broadcast, and nothing broadcast."""
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    vault = Vault(FolderStore(spark, str(tmp_path)))
    spec = SatSpec("SAT", HUB, ("name",), rule=rule, policy=policy, history=history)
    first = spark.range(200).selectExpr("cast(id as int) AS id", "if(id = 5, null, 'a') AS name")
    second = spark.range(210).selectExpr(
        "cast(id as int) AS id", "CASE WHEN id IN (5, 207) THEN null WHEN id = 9 THEN 'b' ELSE 'a' END AS name"
    )
    second = second.unionByName(second.where("id IN (9, 208)"))
    vault.load_satellite(first, spec, "x", batches[0])
    vault.load_satellite(second, spec, "x", batches[1])
    stored = vault.read(spec, first)
    assert stored.where("BATCH_ID = '001'").count() == 200
    expected = [("a",)] * 9 + [(None,)]
    if policy == "hash_diff":
        expected = [("a",)] * 9 + [("b",), (None,)]
    assert tuples(stored.where("BATCH_ID = '002'"), "name") == expected


def test_refresh_replaces_what_its_feed_brought(spark, vault, batches):
    a, b = things(spark, (1, 1, "a"), (2, 1, "b")), things(spark, (2, 1, "b"), (3, 1, "c"))
    vault.load_hub([(a, HUB, "x.csv")], batches[0])
    vault.load_hub([(b, HUB, "y.csv")], batches[1])
    assert Vault(vault.store, refresh=True).load_hub([(b, HUB, "y.csv")], batches[2]).mode == "refresh"
    assert hub_keys(vault, a) == [("1", "001"), ("2", "001"), ("3", "003")]
    assert vault.load_hub([(a, HUB, "x.csv")], batches[3]).mode == "incremental"
    assert hub_keys(vault, a) == [("1", "001"), ("2", "001"), ("3", "003")]


def test_a_batch_that_does_not_sort_last_is_refused(spark, vault):
    rows, late = things(spark, (1, 1, "a"), (2, 1, "b")), datetime(2024, 1, 2)
    vault.load_hub([(rows, HUB, "x.csv")], Batch("9", datetime(2024, 1, 1)))
    with pytest.raises(ValueError, match="does not sort after"):
        vault.load_hub([(rows, HUB, "x.csv")], Batch("10", late))
    assert hub_keys(vault, rows) == [("1", "9"), ("2", "9")]
    vault.load_hub([(things(spark, (3, 1, "c")), HUB, "x.csv")], Batch("91", late))
    vault.load_hub([(rows, HUB, "x.csv")], Batch("9", datetime(2024, 1, 1)))  # a stored one may come again
    assert hub_keys(vault, rows) == [("1", "9"), ("2", "9"), ("3", "91")]


def test_rows_that_differ_beside_a_null_are_versions(spark, vault, batches):
    spec = SatSpec("SAT_N", HUB, ("name", "day"), rule=PASS_NULLS, hash_parent=False)
    frame = lambda *rows: spark.createDataFrame(rows, "id int, name string, day string")
    first = frame((1, "a", None), (1, "b", None))
    vault.load_satellite(first, spec, "x", batches[0])
    vault.load_satellite(frame((1, "b", None), (1, "c", None)), spec, "x", batches[1])
    stored = vault.read(spec, first)
    assert tuples(stored, "name", "HASH_DIFF", "BATCH_ID") == [("a", None, "001"), ("b", None, "001"), ("c", None, "002")]


def test_unreadable_cells_keep_their_line(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    open(path, "w").write('id,name,year\n1,"say ""hi, you"" now",2001\n2,b,20o9\n3,c\n4,\\N,\\N\n5,,\n')
    schema = columns(id=INT, name=TEXT, year=INT)
    rows = {r["id"]: r for r in read_csv(spark, path, schema, report=True).collect()}
    assert rows[1]["name"] == 'say "hi, you" now' and rows[1]["__RAW_LINE"] is None
    assert rows[2]["year"] is None and rows[2]["__RAW_LINE"] == "2,b,20o9"
    assert rows[3]["__RAW_LINE"] == "3,c"
    assert rows[4]["year"] is None and rows[4]["name"] == "\\N" and rows[4]["__RAW_LINE"] is None
    assert rows[5]["__RAW_LINE"] is None
    lines = ['7,"say ""hi"", you",20o9', '8,,20o9', '9, b ,20o9']
    open(path, "w").write("\n".join(["id,name,year", *lines]) + "\n")
    assert [r["__RAW_LINE"] for r in read_csv(spark, path, schema, report=True).collect()] == lines
    open(path, "w").write('id,name,year\n1,"two\nlines",5\n')
    assert tuples(read_csv(spark, path, schema, multi_line=True)) == [(1, "two\nlines", 5)]


def test_two_feeds_of_one_batch(spark, vault, batches):
    """Each feed keeps its own partition, in whatever order the feeds run."""
    a, b = things(spark, (1, 1, "a"), (2, 1, "b")), things(spark, (2, 1, "b"), (3, 1, "c"))
    vault.load_hub([(b, HUB, "zzz.csv")], batches[0])
    vault.load_hub([(a, HUB, "aaa.csv")], batches[0])
    vault.load_hub([(b, HUB, "zzz.csv")], batches[0])
    stored = vault.read(HUB, a)
    assert tuples(stored, "THING_BK", "RECORD_SOURCE") == [("1", "AAA.CSV"), ("2", "ZZZ.CSV"), ("3", "ZZZ.CSV")]


def test_satellite_loads_twice_as_once(spark, vault, batches):
    staged = things(spark, (1, 1, "a"), (1, 1, "a"), (2, 1, "b"))
    changed = things(spark, (1, 1, "a"), (2, 1, "B2"))
    for batch, rows in ((batches[0], staged), (batches[1], staged), (batches[2], changed)):
        vault.load_satellite(rows, SAT, "x.csv", batch)
    assert tuples(vault.read(SAT, staged), "name", "BATCH_ID") == [("B2", "003"), ("a", "001"), ("b", "001")]


def test_order_of_batches_does_not_change_the_keys(spark, tmp_path, batches):
    parts = [things(spark, (n, 1, "x"), (n + 1, 1, "x")) for n in range(3)]
    keys = []
    for name, order in (("up", [0, 1, 2]), ("down", [2, 0, 1])):
        vault = Vault(FolderStore(spark, str(tmp_path / name)))
        for batch, part in zip(batches, order):
            vault.load_link(parts[part], LINK, "x.csv", batch)
        stored = vault.read(LINK, parts[0])
        assert stored.count() == stored.select("PAIR_HK").distinct().count()
        keys.append(tuples(stored, "PAIR_HK"))
    assert keys[0] == keys[1]


def test_batch_id_keeps_its_text(spark, tmp_path):
    """Ids that look like numbers or dates are not turned into them."""
    store = FolderStore(spark, str(tmp_path))
    hub = spark.createDataFrame([], SCHEMA)
    for batch in ("007", "2024-01-01"):
        store.replace_batch("T", spark.createDataFrame([("h", "b", "s", datetime(2024, 1, 1))], SCHEMA), batch, "1")
    assert tuples(store.read("T", SCHEMA), "BATCH_ID", "FEED") == [("007", "1"), ("2024-01-01", "1")]
    assert hub.schema == SCHEMA


def test_target_scan_is_pruned_and_narrow(spark, tmp_path, batches):
    vault = Vault(FolderStore(spark, str(tmp_path)))
    for batch in batches[:3]:
        vault.load_hub([(things(spark, (1, 1, "a")), HUB, "x.csv")], batch)
    target = vault.store.read_others("HUB_THING", SCHEMA, "003", "x.csv").select("THING_HK")
    text = plan(target)
    assert "PartitionFilters: [((BATCH_ID" in text
    assert "ReadSchema: struct<THING_HK:string>" in text


def test_bucketed_target_is_not_shuffled(spark, conf, tmp_path, batches):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("CREATE DATABASE vault_plan")
    store = BucketedStore(spark, str(tmp_path), buckets=4, database="vault_plan")
    vault = Vault(store)
    staged = things(spark, (1, 1, "a"), (2, 1, "b"))
    vault.load_hub([(staged, HUB, "x.csv")], batches[0])
    target = store.read_others("HUB_THING", SCHEMA, "002", "x.csv")
    from vaultwright.operators import build, newrows

    batch = build.hub_rows(staged, HUB, "x.csv", batches[1].ts)
    lines = plan(newrows.new_rows(batch, target, HUB.match)).splitlines()
    held = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    above = [i for i in range(held) if "Exchange" in lines[i]]
    # every exchange belongs to the batch: it is indented under the join's first child
    assert above and all(lines[i].lstrip().startswith(":") for i in above)
    spark.sql("DROP DATABASE vault_plan CASCADE")


def test_missing_table_and_other_errors(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    assert not store.exists("NONE", SCHEMA)
    with pytest.raises(Exception, match="(?i)no_such_format"):
        FolderStore(spark, str(tmp_path), "no_such_format").exists("NONE", SCHEMA)


def test_failed_write_is_raised(spark, tmp_path, batches):
    vault = Vault(FolderStore(spark, str(tmp_path)))
    staged = things(spark, (1, 1, "a")).selectExpr("assert_true(id > 1) AS bad", "id", "other", "name")
    with pytest.raises(Exception):
        vault.load_satellite(staged.selectExpr("id", "cast(bad as string) AS name"), SAT, "x.csv", batches[0])


def test_csv_header_must_match(spark, tmp_path):
    path = str(tmp_path / "races.csv")
    with open(path, "w") as file:
        file.write('raceId,round,circuitId\n1,2,3\n')
    good = columns(raceId=INT, round=INT, circuitId=INT)
    assert tuples(read_csv(spark, path, good)) == [(1, 2, 3)]
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, columns(raceId=INT, circuitId=INT, round=INT)).collect()


def test_csv_cells(spark, tmp_path):
    path = str(tmp_path / "circuits.csv")
    with open(path, "w", encoding="utf-8") as file:
        file.write('id,name,lat,alt\n1,"Nürburg, Ring",50.33,578\n2,\\N,x,\\N\n')
    df = read_csv(spark, path, columns(id=INT, name=TEXT, lat=REAL, alt=INT))
    assert tuples(df) == [(1, "Nürburg, Ring", 50.33, 578), (2, "\\N", None, None)]


def test_stage_refresh_replaces_the_table(spark, tmp_path):
    vault = Vault(FolderStore(spark, str(tmp_path)))
    spec = StageSpec("things", columns(id=INT, name=TEXT), "things.csv", renames={"NAME": "TITLE"})
    vault.stage(spark.createDataFrame([(1, " a ")], spec.schema), spec)
    out = vault.stage(spark.createDataFrame([(2, "\\N"), (3, "c")], spec.schema), spec)
    assert tuples(out, "ID", "TITLE") == [(2, ""), (3, "C")]
    assert vault.create_view(spec) == "view created for things: stg_things"
    assert tuples(spark.table("stg_things"), "ID") == [(2,), (3,)]


def test_rejects_are_kept(spark, vault, batches):
    staged = things(spark, (None, 1, "lost"), (1, 1, "kept"))
    vault.reject(staged, "things", ["id"], batches[0])
    assert tuples(vault.store.read("REJECTED_THINGS", staged.schema), "id", "name") == [(None, "lost")]


def test_inventory(spark, tmp_path, batches):
    vault = Vault(FolderStore(spark, str(tmp_path)))
    staged = things(spark, (1, 1, "a"), (2, 1, "b"))
    vault.load_hub([(staged, HUB, "x.csv")], batches[0])
    vault.load_satellite(staged, SAT, "x.csv", batches[1])
    out = inventory({"hub": vault.read(HUB, staged), "sat": vault.read(SAT, staged)})
    assert tuples(out) == [("hub", 2, datetime(2024, 1, 1)), ("sat", 2, datetime(2024, 1, 2))]


def test_batch_is_checked():
    with pytest.raises(ValueError):
        Batch("a/b", datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        Batch("1", datetime(2024, 1, 1, tzinfo=timezone.utc))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
