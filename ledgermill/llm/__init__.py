"""Operators of a training-data pipeline over documents and web pages.

Task functions are sent to executors by value, so the package need not be
installed there.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
