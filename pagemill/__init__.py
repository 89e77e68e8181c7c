"""Web-archive cleaning on Spark: manifest, fetch, records, text, corpus, ledger."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the plan, so a
# cluster needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
