"""Postmill: mail analytics as Spark DataFrame jobs.

``functions``  column expressions (headers, bodies, text, entities, vectors)
``operators``  frame operators (threads, relations, scoring, topics, clustering)
``sources``    readers, selections, checkpoints, table loading and export
``plans``      the end-to-end jobs built from them
``streaming``  the incremental variants
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
