"""Training-data operators: deduplication, decontamination, quality, language, extraction, tokens, language models.

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames; ``queries`` registers one checked query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, and what is broadcast is arrays, bytes and dicts only, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
