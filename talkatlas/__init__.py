"""Transcript analytics and recommendation as DataFrame operators.

Layout: ``sources`` reads and writes files, ``functions`` holds column
expressions, ``operators`` holds DataFrame-to-DataFrame operators and ``plans``
holds the registered queries with their SQL twins.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
