"""Operators that prepare text for language-model training, on Spark DataFrames.

Functions of this subpackage travel to the workers by value, so these need numpy and pyarrow but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
