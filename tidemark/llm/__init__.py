"""Training-data operators: thirteen corpus operators and their registered queries.

Nothing else in the library imports this subpackage.  Functions that run in
Spark's Python workers are pickled by value, so the workers need numpy,
pyarrow and the public packages named in each module, but not ``tidemark``.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
