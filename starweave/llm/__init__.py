"""Training-data operators: dedup, decontamination, language, quality, mixing,
search, archives, token files and shards. Nothing outside this subpackage and
``corpus_pipeline.py`` imports it."""

import sys

from pyspark import cloudpickle

# Tasks get the functions they run along with the job: executors need no copy
# of this subpackage.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
