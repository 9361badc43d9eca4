"""Operators for preparing large text corpora for model training.

Thirteen stand-alone operators (chat formatting, token files, line, shingle and
substring deduplication, mixing, sharding, decontamination, toxicity,
fingerprints, token counts, embedding whitening, phrases).  Each takes DataFrames and column names and returns a DataFrame;
``llm.queries`` binds them to the driver tables.  Nothing else in the library
imports this package.

Functions that run inside Spark's Python workers are shipped by value, so a
cluster needs numpy and pyarrow on its workers but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
