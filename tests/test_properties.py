"""Random batches against a model in plain Python."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

from vaultwright.loading.vault import Vault
from vaultwright.sources.store import FolderStore
from vaultwright.spec import BATCH_ID, Batch, HubSpec, SatSpec

HUB = HubSpec("THING", "id")


def random_batches(seed):
    """Batches with copies, several versions of a parent, NULLs and one busy parent."""
    rng = random.Random(seed)
    return [
        [
            (rng.choice([7, 7, 7, None, *range(5)]), rng.choice(["a", "b", "a||b", "", None]), rng.choice([1, None]))
            for _ in range(rng.randrange(0, 14))
        ]
        for _ in range(4)
    ]


def version(row):
    """What the standard rule tells apart: every value, NULL and empty text included."""
    return tuple("\0" if v is None else str(v) for v in row)


def model(batches, history):
    stored, last = [], {}
    for number, rows in enumerate(batches):
        seen = {r[1:] for r in stored}
        versions = {version(r) for r in rows if r[0] is not None}
        fresh = [v for v in versions if (v not in seen if history == "any" else v not in last.get(v[0], set()))]
        stored += [(number, *v) for v in fresh]
        for key in {v[0] for v in fresh}:
            last[key] = {v for v in fresh if v[0] == key}
    return sorted((n, *v) for n, *v in stored)


@pytest.mark.parametrize(
    "seed, history, threshold",
    [(1, "any", "10MB"), (1, "latest", "-1"), (2, "any", "-1"), (2, "latest", "10MB"), (3, "any", "2KB")],
)
def test_satellite_and_hub_follow_the_model(spark, conf, tmp_path, seed, history, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    vault = Vault(FolderStore(spark, str(tmp_path)))
    spec = SatSpec("SAT", HUB, ("name", "n"), history=history)
    batches = random_batches(seed)
    keys = {}
    for number, rows in enumerate(batches):
        staged = spark.createDataFrame(rows, "id int, name string, n int")
        batch = Batch(str(number), datetime(2024, 1, number + 1))
        vault.load_hub([(staged, HUB, "x")], batch)
        for _ in range(1 + number % 2):  # every other batch is retried
            vault.load_satellite(staged, spec, "x", batch)
        for row in rows:
            if row[0] is not None:
                keys.setdefault(str(row[0]), str(number))

    hub = vault.read(HUB, staged)
    assert sorted((r["THING_BK"], r[BATCH_ID]) for r in hub.collect()) == sorted(keys.items())
    parents = {r["THING_HK"]: r["THING_BK"] for r in hub.collect()}
    stored = vault.read(spec, staged).collect()
    actual = sorted((int(r[BATCH_ID]), *version((parents[r["THING_HK"]], r["name"], r["n"]))) for r in stored)
    assert actual == model(batches, history)
