"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
