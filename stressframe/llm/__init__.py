"""Training-data operators: quality, dedup, decontamination, scoring, scans, tokens.

Each module holds one operator with a general interface; ``queries`` registers
the thin ``opN_*`` queries.  Nothing else in the library imports this package.
Functions that run in Python workers travel by value, so executors need only
the public libraries, not a copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
