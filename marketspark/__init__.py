"""Market-data analytics as Spark jobs.

Every operator is a function from DataFrame to DataFrame over a panel of all
symbols.  Nothing here creates a session or starts work on import.
"""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the executors as code, so nothing
# has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
