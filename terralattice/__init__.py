"""Terralattice: multi-band geostationary imagery as Spark DataFrames.

Catalog, validate, project, regrid, composite, store and re-run imagery with
DataFrame in / DataFrame out functions. See README.md for the operator map.
"""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so that these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
