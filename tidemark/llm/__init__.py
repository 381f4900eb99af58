"""Operators for preparing training data: private data, nearest neighbours,
deduplication, decontamination, quality, packing, token counts and language-model
scoring. Nothing outside this folder (and ``corpus_pipeline.py``) imports it."""

import sys

from pyspark import cloudpickle

# The Python that runs inside tasks travels with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
