"""Operators for training-data corpora: near-duplicates, language, quality,
personal data, secrets, licences, decontamination and packing.

Nothing else in the library imports this package. Each operator module keeps a
general interface (texts, spans, pairs); ``queries`` derives the registered
result tables from them.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so the package
# itself needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
