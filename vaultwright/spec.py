"""Declarations: what a stage table, hub, link and satellite consist of."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import types as T

RECORD_SOURCE = "RECORD_SOURCE"
LOAD_DATE = "LOAD_DATE"
HASH_DIFF = "HASH_DIFF"
BATCH_ID = "BATCH_ID"
FEED = "FEED"
# What tells versions apart where the hash diff is NULL; never stored.
VERSION = "__VERSION"

AUDIT_FIELDS = [
    T.StructField(RECORD_SOURCE, T.StringType()),
    T.StructField(LOAD_DATE, T.TimestampNTZType()),
]

INT, LONG, REAL, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def columns(**types: T.DataType) -> T.StructType:
    """A file schema from column names and types, in file order."""
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.\-]+")


@dataclass(frozen=True)
class HashRule:
    """How columns become the text that is hashed.

    nulls:    ``mark`` writes a mark that no text can equal, ``blank`` keeps the position
              with an empty text, ``skip`` leaves the column out, ``propagate`` makes the
              whole hash NULL.
    numerics: ``fixed`` writes floating point with four decimals where that is the whole
              value, so the text does not depend on an engine's double formatting;
              ``plain`` casts.
    escape:   texts are escaped, so that none can hold the separator or the mark.
    """

    separator: str = "||"
    nulls: str = "blank"
    numerics: str = "fixed"
    escape: bool = False

    def __post_init__(self) -> None:
        if self.nulls not in ("mark", "blank", "skip", "propagate"):
            raise ValueError(f"unknown null rule {self.nulls!r}")
        if self.numerics not in ("fixed", "plain"):
            raise ValueError(f"unknown numeric rule {self.numerics!r}")


STANDARD = HashRule(nulls="mark", escape=True)
# The two older conventions: no separator, NULLs left out or passed on.
SKIP_NULLS = HashRule(separator="", nulls="skip", numerics="plain")
PASS_NULLS = HashRule(separator="", nulls="propagate", numerics="plain")
LINK_STANDARD = HashRule(separator="||", nulls="propagate", numerics="plain", escape=True)


@dataclass(frozen=True)
class Batch:
    """One load: an id that sorts after all earlier ids, and its single timestamp."""

    id: str
    ts: datetime

    def __post_init__(self) -> None:
        if not _PLAIN_NAME.fullmatch(self.id):
            raise ValueError(f"batch id {self.id!r} is not usable as a folder name")
        if self.ts.tzinfo is not None:
            raise ValueError("batch timestamp is UTC wall time without a zone")


@dataclass(frozen=True)
class StageSpec:
    """A stage table: file schema, cleansing, and declared constraints."""

    name: str
    schema: T.StructType
    source: str
    renames: dict[str, str] = field(default_factory=dict)
    null_marker: str | None = "\\N"
    null_int: int | None = None
    round_digits: int | None = 4
    keep_case: tuple[str, ...] = ("url",)
    dates: tuple[str, ...] = ()
    datetimes: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, Any] = field(default_factory=dict)
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)


@dataclass(frozen=True)
class HubSpec:
    """A hub on one business key column of the staged frame."""

    entity: str
    key: str
    table: str = ""

    @property
    def name(self) -> str:
        return self.table or f"HUB_{self.entity}"

    @property
    def hk(self) -> str:
        return f"{self.entity}_HK"

    @property
    def bk(self) -> str:
        return f"{self.entity}_BK"

    @property
    def columns(self) -> list[str]:
        return [self.hk, self.bk, RECORD_SOURCE, LOAD_DATE]

    @property
    def match(self) -> list[str]:
        """What an incoming row is compared on."""
        return [self.hk]

    @property
    def spread(self) -> list[str]:
        """What stored rows can be bucketed by without a hot bucket."""
        return [self.hk]

    def schema(self, staged: T.StructType) -> T.StructType:
        keys = [T.StructField(c, T.StringType()) for c in (self.hk, self.bk)]
        return T.StructType([*keys, *AUDIT_FIELDS])


@dataclass(frozen=True)
class LinkSpec:
    """A link: entity name -> staged business key column, in hashing order.

    order: the business keys by which its rows are stored, so that equal hash keys lie
           together and take little room. The rows then reach their place in one
           shuffle and are made unique there; leave it out where keys repeat often.
    """

    entity: str
    refs: dict[str, str]
    table: str = ""
    rule: HashRule = LINK_STANDARD
    order: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.table or f"LNK_{self.entity}"

    @property
    def hk(self) -> str:
        return f"{self.entity}_HK"

    @property
    def keys(self) -> list[str]:
        return list(self.refs.values())

    @property
    def ref_hks(self) -> list[str]:
        return [f"{entity}_HK" for entity in self.refs]

    @property
    def columns(self) -> list[str]:
        return [*self.ref_hks, self.hk, RECORD_SOURCE, LOAD_DATE]

    @property
    def match(self) -> list[str]:
        """What an incoming row is compared on."""
        return [self.hk]

    @property
    def spread(self) -> list[str]:
        """What stored rows can be bucketed by without a hot bucket."""
        return [self.hk]

    def schema(self, staged: T.StructType) -> T.StructType:
        hks = [T.StructField(c, T.StringType()) for c in (*self.ref_hks, self.hk)]
        return T.StructType([*hks, *AUDIT_FIELDS])


@dataclass(frozen=True)
class SatSpec:
    """A satellite of a hub or link.

    policy:  ``hash_diff`` inserts versions not seen before, ``key`` only parents
             not seen before.
    history: ``any`` compares with all stored versions, ``latest`` with the newest,
             so that a return to an old value is a new version.
    hashed:  the attributes that enter the hash diff, if not all.
    """

    name: str
    parent: HubSpec | LinkSpec
    attributes: tuple[str, ...]
    rule: HashRule = STANDARD
    hash_parent: bool = True
    policy: str = "hash_diff"
    history: str = "any"
    hashed: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.policy not in ("hash_diff", "key"):
            raise ValueError(f"unknown satellite policy {self.policy!r}")
        if self.history not in ("any", "latest"):
            raise ValueError(f"unknown satellite history {self.history!r}")

    @property
    def hk(self) -> str:
        return self.parent.hk

    @property
    def parent_keys(self) -> list[str]:
        return [self.parent.key] if isinstance(self.parent, HubSpec) else self.parent.keys

    @property
    def columns(self) -> list[str]:
        return [self.hk, HASH_DIFF, *self.attributes, RECORD_SOURCE, LOAD_DATE]

    @property
    def version(self) -> list[str]:
        """What tells one version from another: the hash diff alone where it covers
        the parent, half the bytes to shuffle."""
        if self.rule.nulls == "propagate":
            return [self.hk, VERSION]
        return [HASH_DIFF] if self.hash_parent and self.history == "any" else [self.hk, HASH_DIFF]

    @property
    def match(self) -> list[str]:
        return [self.hk] if self.policy == "key" else self.version

    @property
    def spread(self) -> list[str]:
        return [HASH_DIFF if c == VERSION else c for c in self.version]

    def schema(self, staged: T.StructType) -> T.StructType:
        return T.StructType([
            T.StructField(self.hk, T.StringType()),
            T.StructField(HASH_DIFF, T.StringType()),
            *[T.StructField(c, staged[c].dataType) for c in self.attributes],
            *AUDIT_FIELDS,
        ])
