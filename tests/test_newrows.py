"""Insert-only-new and its physical forms."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import plan, tuples

from vaultwright.operators import build, joins, newrows
from vaultwright.spec import PASS_NULLS, HubSpec, SatSpec

HUB = HubSpec("THING", "id")
SAT = SatSpec("SAT", HUB, ("name",))
DAYS = [datetime(2024, 1, d) for d in range(1, 6)]


def sat(spark, spec, day, *rows):
    return build.sat_rows(spark.createDataFrame(list(rows), "id int, name string"), spec, "x", DAYS[day])


@pytest.fixture
def written(spark, tmp_path):
    """Hubs of the keys 0..9999 and of a batch, as stored tables."""

    def write(name, first, last):
        staged = spark.range(first, last).selectExpr("cast(id as int) AS id")
        path = str(tmp_path / name)
        build.hub_rows(staged, HUB, name, DAYS[0]).write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_forms_agree(spark, conf, written):
    target, batch = written("target", 0, 10_000), written("batch", 9_900, 10_050)
    expected = [(str(k),) for k in range(10_000, 10_050)]
    assert tuples(newrows.new_rows(batch, target, HUB.match), "THING_BK") == expected
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    packed = newrows.new_rows(batch, target, HUB.match, packed=True)
    assert tuples(packed, "THING_BK") == expected
    assert "unhex" in plan(packed)
    assert tuples(newrows.new_rows(batch, target, HUB.match, target_unique=False), "THING_BK") == expected
    assert tuples(newrows.new_rows_small_batch(batch, target, HUB.match), "THING_BK") == expected


def test_plain_form_is_an_anti_join(spark, written):
    text = plan(newrows.new_rows(written("batch", 5, 15), written("target", 0, 10), HUB.match))
    assert "LeftAnti" in text
    assert "RightOuter" not in text


def test_scans_read_only_the_keys(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    hub = HubSpec("CUSTOMER", "o_custkey")
    text = plan(build.hub_rows(orders, hub, "x", DAYS[0]))
    assert "ReadSchema: struct<o_custkey:bigint>" in text
    assert "PushedFilters: [IsNotNull(o_custkey)]" in text


def exchanges(df):
    return [line for line in plan(df).splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_small_batch_does_not_shuffle_the_target(spark, written):
    target, batch = written("target", 0, 10_000), written("batch", 9_900, 10_050)
    df = newrows.new_rows_small_batch(batch, target, HUB.match)
    text = plan(df)
    assert "LeftSemi" in text and "LeftAnti" in text
    # the one shuffle makes the hits unique, above the join with the target
    lines = text.splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    scan = next(i for i, line in enumerate(lines) if i > semi and "FileScan" in line and "/target" in line)
    assert not any("Exchange hashpartitioning" in line for line in lines[semi:scan])


def test_form_is_chosen_by_counted_size(spark, conf, written):
    target, batch = written("target", 0, 10_000), written("batch", 9_900, 10_050)
    conf("spark.sql.autoBroadcastJoinThreshold", "20KB")
    small = newrows.new_rows_by_size(batch, target, HUB.match, row_bound=150)
    large = newrows.new_rows_by_size(batch, target, HUB.match, row_bound=1_000_000)
    assert "LeftSemi" in plan(small)
    assert "LeftSemi" not in plan(large)
    assert tuples(small) == tuples(large)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Broadcast" not in plan(newrows.new_rows_by_size(batch, target, HUB.match, row_bound=1))


@pytest.mark.parametrize(
    "setting, expected",
    [("-1", 0), ("0", 0), ("10485760", 10485760), ("10485760b", 10485760), ("10MB", 10485760), ("64k", 65536), ("1g", 2**30)],
)
def test_broadcast_limit_reads_spark_sizes(spark, conf, setting, expected):
    conf("spark.sql.autoBroadcastJoinThreshold", setting)
    assert joins.broadcast_limit(spark.range(1)) == expected


def test_changed_row_by_key_and_by_hash_diff(spark):
    stored = sat(spark, SAT, 0, (1, "a"), (2, "b"))
    batch = sat(spark, SAT, 1, (1, "a"), (2, "changed"), (3, "c"))
    by_key = SatSpec("SAT", HUB, ("name",), policy="key")
    assert tuples(newrows.new_versions(batch, stored, by_key), "name") == [("c",)]
    assert tuples(newrows.new_versions(batch, stored, SAT), "name") == [("c",), ("changed",)]


def test_rows_grouped_by_version_meet_the_target_without_another_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    stored = sat(spark, SAT, 0, (1, "a"))
    batch = sat(spark, SAT, 1, (1, "b"))
    # one exchange for the batch rows, one for the target's keys
    assert len(exchanges(newrows.new_versions(batch, stored, SAT))) == 2


def test_null_hash_diff_is_not_inserted_twice(spark):
    spec = SatSpec("SAT", HUB, ("name",), rule=PASS_NULLS, hash_parent=False)
    stored = sat(spark, spec, 0, (1, None), (2, "b"))
    batch = sat(spark, spec, 1, (1, None), (2, "b"), (3, None))
    assert stored.where("HASH_DIFF IS NULL").count() == 1
    for row_bound in (None, 3):
        out = newrows.new_versions(batch, stored, spec, row_bound=row_bound)
        assert tuples(out, "THING_HK") == tuples(build.hub_rows(spark.createDataFrame([(3,)], "id int"), HUB, "x", DAYS[0]), "THING_HK")


@pytest.mark.parametrize("history, expected", [("any", 2), ("latest", 3)])
def test_return_to_an_old_value(spark, history, expected):
    spec = SatSpec("SAT", HUB, ("name",), history=history)
    stored = sat(spark, spec, 0, (1, "A"), (2, "x"))
    for day, value in ((1, "B"), (2, "A")):
        batch = sat(spark, spec, day, (1, value), (2, "x"))
        stored = stored.unionByName(newrows.new_versions(batch, stored, spec))
    hk = "C4CA4238A0B923820DCC509A6F75849B"
    assert stored.where(stored.THING_HK == hk).count() == expected
    assert stored.where(stored.THING_HK != hk).count() == 1


def test_latest_with_several_versions_in_one_load(spark):
    """Both versions of the latest load count as current, so neither comes again."""
    spec = SatSpec("SAT", HUB, ("name",), history="latest")
    stored = sat(spark, spec, 0, (1, "A"), (1, "B"))
    assert newrows.new_versions(sat(spark, spec, 1, (1, "A"), (1, "B")), stored, spec).count() == 0


def test_busy_parent_by_key(spark, conf):
    """The target holds thousands of versions of one parent; its keys are made
    unique before they meet the batch."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    spec = SatSpec("SAT", HUB, ("name",), policy="key")
    rows = spark.range(3000).selectExpr("cast(if(id % 3 = 0, 7, id) as int) AS id", "cast(id as string) AS name")
    stored = build.sat_rows(rows, spec, "x", DAYS[0])
    batch = build.sat_rows(
        spark.range(3010).selectExpr("cast(id as int) AS id", "'new' AS name"), spec, "x", DAYS[1]
    )
    out = newrows.new_versions(batch, stored, spec)
    held = {r[0] for r in rows.select("id").collect()}
    assert out.count() == sum(1 for k in range(3010) if k not in held)
    text = plan(out)
    assert text.index("LeftAnti") < text.index("HashAggregate")


def test_batch_may_come_from_the_target(spark):
    """Both sides of the join share their columns' origin."""
    stored = sat(spark, SAT, 0, (1, "a"), (2, "b"))
    assert newrows.new_rows(stored, stored, SAT.match).count() == 0
    assert newrows.new_rows_small_batch(stored, stored.where("name = 'a'"), SAT.match).count() == 1


def test_right_outer(spark):
    target = spark.createDataFrame([("k1", "old")], "hk string, t string")
    batch = spark.createDataFrame([("k1", 1), ("k2", 2), ("k2", 3)], "hk string, v int")
    assert tuples(newrows.right_outer_using(target, batch, "hk")) == [
        ("k1", "old", 1), ("k2", None, 2), ("k2", None, 3),
    ]
    named = batch.withColumnRenamed("hk", "r_hk")
    assert tuples(newrows.right_outer_on(target, named, "hk", "r_hk"), "hk", "r_hk", "v") == [
        ("k1", "k1", 1), (None, "k2", 2), (None, "k2", 3),
    ]
