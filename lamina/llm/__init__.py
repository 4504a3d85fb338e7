"""Training-data operators: cleaning, de-duplication, packing, search, archives.

Nothing else in the library imports this package. The code that runs inside
Spark's Python workers travels with the task, so executors need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
