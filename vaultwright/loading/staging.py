"""Raw frame to staged frame, by declaration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwright.functions.parse import parse_date, parse_datetime
from vaultwright.operators.clean import cleanse, fill_defaults
from vaultwright.spec import StageSpec


def stage(raw: DataFrame, spec: StageSpec, keys: Sequence[str] = ()) -> DataFrame:
    """Cleanse, parse, rename and default the columns of a raw frame.

    ``keys`` names the staged columns that are business keys. They take no default and
    no blank: a missing one stays NULL, so that its row is rejected instead of loaded
    under a key that no file held. A date and a time stay beside the timestamp made of
    them, which is NULL where either is missing.
    """
    before = {new: old for old, new in spec.renames.items()}
    key_names = [before.get(key, key) for key in keys]
    df = cleanse(
        raw,
        keys=key_names,
        keep_case=spec.keep_case,
        null_marker=spec.null_marker,
        null_int=spec.null_int,
        round_digits=spec.round_digits,
    )
    if spec.dates:
        df = df.withColumns({name: parse_date(F.col(name)) for name in spec.dates})
    for name, (date, time) in spec.datetimes.items():
        missing = F.col(time).isin("", spec.null_marker or "\\N")
        df = df.withColumns({
            name: parse_datetime(F.col(date), F.col(time)),
            date: parse_date(F.col(date)),
            time: F.when(~missing, F.col(time)),
        })
    if spec.renames:
        df = df.withColumnsRenamed(spec.renames)
    defaults = {name: value for name, value in spec.defaults.items() if name not in keys}
    return fill_defaults(df, defaults) if defaults else df
