"""Operators for large training corpora. Nothing outside this subpackage imports it."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions with the job, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
