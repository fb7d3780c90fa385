"""Operators of a training-data pipeline. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions travel to the Python workers as they are: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from vaultwright.llm.queries import QUERIES  # noqa: E402

__all__ = ["QUERIES"]
