"""Tables that change over at once, keys that several feeds hold, ids over batches, checks of vault tables."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from conftest import tuples
from test_store import HUB, SAT, things, vault  # noqa: F401

from vaultwright.loading.vault import Vault
from vaultwright.operators.build import with_version
from vaultwright.operators.newrows import newest_versions
from vaultwright.sources.store import FolderStore
from vaultwright.spec import INT, PASS_NULLS, STANDARD, SatSpec, columns

SCHEMA = HUB.schema(columns(id=INT))


class Dying(FolderStore):
    def publish(self, table, folders):
        raise ConnectionError("lost")


def folders(store, table):
    return sorted(d for d, _, files in os.walk(store.path(table)) if any(f.startswith("part-") for f in files))


@pytest.mark.parametrize("refresh", [False, True])
def test_a_load_that_dies_leaves_the_table(spark, tmp_path, batches, refresh):
    good = Vault(FolderStore(spark, str(tmp_path)))
    good.load_hub([(things(spark, (1, 1, "a"), (2, 1, "b")), HUB, "x.csv")], batches[0])
    before = tuples(good.read(HUB, things(spark)))
    for batch in batches[:2]:
        with pytest.raises(ConnectionError):
            Vault(Dying(spark, str(tmp_path)), refresh=refresh).load_hub([(things(spark, (3, 1, "c")), HUB, "x.csv")], batch)
        assert tuples(good.read(HUB, things(spark))) == before
    good.load_hub([(things(spark, (3, 1, "c")), HUB, "x.csv")], batches[1])
    assert tuples(good.read(HUB, things(spark)), "THING_BK") == [("1",), ("2",), ("3",)]


def test_a_reader_keeps_what_it_began_with(spark, tmp_path, batches):
    """The publication before stays for readers that have begun; older ones are deleted."""
    vault = Vault(FolderStore(spark, str(tmp_path)), refresh=True)
    readers = []
    for n, batch in enumerate(batches):
        vault.load_hub([(things(spark, (n, 1, "a")), HUB, "x.csv")], batch)
        readers.append(vault.read(HUB, things(spark)))
        assert [tuples(r, "THING_BK") for r in readers[-2:]] == [[(str(k),)] for k in range(max(0, n - 1), n + 1)]
    assert len(folders(vault.store, HUB.name)) == 2


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    store.replace_table("T", things(spark, (1, 1, "a")))

    class Late(FolderStore):
        def _names(self, path):
            return super()._names(path)[:1] if path.endswith("_published") else super()._names(path)

    store.replace_table("T", things(spark, (2, 1, "a")))
    late = Late(spark, str(tmp_path))
    if sorted(late._names(f"{store.path('T')}/_published")) == sorted(store._names(f"{store.path('T')}/_published"))[:1]:
        with pytest.raises(RuntimeError, match="another writer"):
            late.replace_table("T", things(spark, (3, 1, "a")))
    assert tuples(store.read_table("T"), "id") == [(2,)]


def test_tables_of_earlier_versions_are_taken_over(spark, tmp_path, batches):
    """Partitions written without a publication are read, and stay beside what is published."""
    rows = spark.createDataFrame([("H1", "1", "OLD.CSV", None)], SCHEMA)
    rows.write.parquet(f"{tmp_path}/{HUB.name}/BATCH_ID=000/FEED=old.csv")
    vault = Vault(FolderStore(spark, str(tmp_path)))
    assert vault.store.batch_ids(HUB.name) == {"000"} and vault.store.read(HUB.name, SCHEMA).count() == 1
    vault.load_hub([(things(spark, (7, 1, "a")), HUB, "x.csv")], batches[0])
    assert tuples(vault.store.read(HUB.name, SCHEMA), "THING_BK", "BATCH_ID", "FEED") == [("1", "000", "old.csv"), ("7", "001", "x.csv")]


def test_shared_hub_loses_a_key_with_its_last_feed(spark, vault, batches):  # noqa: F811
    load = lambda feed, batch, *ids: vault.load_hub([(things(spark, *[(i, 1, "a") for i in ids]), HUB, feed)], batch, shared=True)
    held = lambda: tuples(vault.read(HUB, things(spark)), "THING_BK", "RECORD_SOURCE", "FEED", "BATCH_ID")
    load("a", batches[0], 1, 2, 3)
    load("b", batches[0], 2, 3, 4)
    load("b", batches[0], 2, 3, 4)
    load("b", batches[1], 1)
    load("c", batches[1], 3)
    vault.refresh = True
    load("a", batches[2], 5)
    assert held() == [("1", "B", "b", "002"), ("2", "B", "b", "001"), ("3", "B", "b", "001"), ("4", "B", "b", "001"), ("5", "A", "a", "003")]
    load("b", batches[3], 4, 5)
    assert held() == [("3", "C", "c", "002"), ("4", "B", "b", "004"), ("5", "A", "a", "003")]
    load("a", batches[4])
    assert held() == [("3", "C", "c", "002"), ("4", "B", "b", "004"), ("5", "B", "b", "004")]


def test_ids_go_on_and_stay(spark, vault, batches):  # noqa: F811
    rows = lambda *keys: spark.createDataFrame([(k, "x") for k in keys], "k string, v string")
    number = lambda batch, *keys: tuples(vault.number(rows(*keys), ["k"], "things", "x.csv", batch), "ID", "k")
    assert number(batches[0], "b", "d", "b") == [(1, "b"), (1, "b"), (2, "d")]
    assert number(batches[1], "a", None, "d", "e") == [(2, "d"), (3, None), (4, "a"), (5, "e")]
    assert number(batches[1], "a", None, "d", "e") == [(2, "d"), (3, None), (4, "a"), (5, "e")]
    assert number(batches[2]) == []
    assert number(batches[3], None, "z", "a") == [(3, None), (4, "a"), (6, "z")]
    with pytest.raises(ValueError, match="sort"):
        vault.number(rows("q"), ["k"], "things", "x.csv", batches[2].__class__("000", batches[2].ts))


def test_checks_of_vault_tables(spark, vault, batches):  # noqa: F811
    staged = things(spark, (1, 1, "a"), (2, 1, "b"))
    vault.load_hub([(staged, HUB, "x.csv")], batches[0])
    vault.load_satellite(staged, SAT, "x.csv", batches[0])
    assert vault.check_table(HUB, staged.schema, batches[0]).isEmpty() and vault.check_table(SAT, staged.schema, batches[0]).isEmpty()
    again = vault.read(HUB, staged).where("THING_BK = '2'").drop("BATCH_ID", "FEED")
    vault.store.replace_batch(HUB.name, again, batches[1].id, "y.csv", HUB.spread)
    assert vault.check_table(HUB, staged.schema, batches[0]).isEmpty()
    assert tuples(vault.check_table(HUB, staged.schema, batches[1]), "rule", "column_name", "row_count") == [("primary_key", "THING_HK", 2)]


LATEST = SatSpec("SAT_LATEST", HUB, ("name",), history="latest")
VERSIONS = [
    [(1, 1, "a"), (2, 1, "b"), (3, 1, None)],
    [(1, 1, "x"), (2, 1, "b")],
    [(1, 1, "a"), (4, 1, "d")],
    [(1, 1, "a"), (2, 1, "c"), (3, 1, "")],
]


def junk(store, table, batch):
    """Make what a batch stored unreadable."""
    for folder, _, files in os.walk(store.path(table)):
        if f"BATCH_ID={batch.id}" in folder:
            for name in files:
                with open(os.path.join(folder, name), "wb") as out:
                    out.write(b"no parquet")


@pytest.mark.parametrize("threshold, rule", [("10MB", STANDARD), ("-1", PASS_NULLS)])
def test_loads_read_the_newest_versions_instead_of_the_history(spark, conf, tmp_path, batches, threshold, rule):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    spec = replace(LATEST, rule=rule, hash_parent=rule is STANDARD)
    kept, plain = Vault(FolderStore(spark, str(tmp_path / "kept"))), Vault(FolderStore(spark, str(tmp_path / "plain")))
    plain._renew_current = lambda *args: None
    stored = []
    for n, (rows, batch) in enumerate(zip(VERSIONS, batches)):
        for vault in (kept, plain):
            for _ in range(1 + (n == 3)):  # a repeated load finds what was newest before it
                vault.load_satellite(things(spark, *rows), spec, "x.csv", batch)
        assert plain.current(spec, batch) is None
        own = [tuples(v.read(spec, things(spark, *rows)).where(f"BATCH_ID = '{batch.id}'"), *spec.columns) for v in (kept, plain)]
        assert own[0] == own[1]
        stored.append([r[2] for r in own[0]])
        if n < 2:
            junk(kept.store, spec.name, batch)
    assert [sorted(names, key=repr) for names in stored] == [["a", "b", None], ["x"], ["a", "d"], ["", "c"]]
    newest = kept.current(spec, batches[3])
    history = with_version(plain.read(spec, things(spark, *VERSIONS[0])), spec)
    assert tuples(newest) == tuples(newest_versions(history, spec.version))


def test_the_history_is_read_again_where_the_newest_versions_do_not_follow_from_it(spark, tmp_path, batches):
    vault = Vault(FolderStore(spark, str(tmp_path)))
    for rows, batch in zip(VERSIONS[:3], batches):
        vault.load_satellite(things(spark, *rows), LATEST, "x.csv", batch)
    vault.load_satellite(things(spark, (1, 1, "y")), LATEST, "x.csv", batches[1])  # an older batch, changed
    assert vault.current(LATEST, batches[2]) is None
    vault.load_satellite(things(spark, (1, 1, "y"), (2, 1, "b")), LATEST, "x.csv", batches[3])
    found = tuples(vault.read(LATEST, things(spark, *VERSIONS[0])), "name", "BATCH_ID")
    assert ("y", "004") in found and ("b", "004") not in found
    assert vault.current(LATEST, batches[3]).count() == 4


def test_feeds_with_letters_beyond_ascii_come_again(spark, tmp_path, batches):
    vault = Vault(FolderStore(spark, str(tmp_path)))
    for _ in range(2):
        vault.load_hub([(things(spark, (1, 1, "a")), HUB, "a/b>c=ö.csv")], batches[0])
    vault.load_hub([(things(spark, (1, 1, "a"), (2, 1, "a")), HUB, "x.csv")], batches[0])
    assert tuples(vault.read(HUB, things(spark)), "THING_BK", "FEED") == [("1", "a/b>c=ö.csv"), ("2", "x.csv")]


def test_compaction_keeps_batches_and_feeds(spark, tmp_path, batches):
    vault = Vault(FolderStore(spark, str(tmp_path)))
    load = lambda ids, batch, feed="x.csv": vault.load_hub([(things(spark, *[(i, 1, "a") for i in ids]), HUB, feed)], batch)
    read = lambda: tuples(vault.read(HUB, things(spark)), "THING_BK", "BATCH_ID", "FEED")
    for n, batch in enumerate(batches[:4]):
        load([n, n + 10], batch)
    load([77], batches[1], "a/b>c=ö")
    before = read()
    assert vault.store.compact(HUB.name, batches[2].id) == 4
    assert read() == before
    named = {f.split("/>")[-1] for f in vault.store.published(HUB.name)}
    assert len(named) == 2
    merged = next(f for f in named if f.startswith("merged/"))
    assert len([f for f in os.listdir(f"{vault.store.path(HUB.name)}/{merged}") if f.startswith("part-")]) == 1
    assert vault.store.batch_ids(HUB.name) == {b.id for b in batches[:4]}
    with pytest.raises(ValueError):
        load([5], replace(batches[0], id="0000"))
    # An old load comes again: its rows in the merged folder are no longer part of the table.
    load([1, 99], batches[1])
    assert read() == sorted([r for r in before if r[1:] != ("002", "x.csv")] + [("1", "002", "x.csv"), ("99", "002", "x.csv")], key=repr)
    # A key that only merged loads hold does not come again, and a second merge takes in the first.
    load([0, 99, 50], batches[4])
    assert vault.store.compact(HUB.name, batches[4].id) == 4
    assert len({f.split("/>")[-1] for f in vault.store.published(HUB.name)}) == 1
    assert [r[0] for r in read() if r[1] == "005"] == ["50"]
    assert vault.store.compact(HUB.name, batches[4].id) == 0
    # Refreshing a feed takes its rows out of the merged folder.
    Vault(vault.store, refresh=True).load_hub([(things(spark, (8, 1, "a")), HUB, "x.csv")], batches[4])
    assert read() == [("77", "002", "a/b>c=ö"), ("8", "005", "x.csv")]
    folders_there = folders(vault.store, HUB.name)
    assert vault.store.read_table(HUB.name).count() == 2 and len(folders_there) >= 2
