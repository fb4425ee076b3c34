"""Text-corpus preparation as Spark jobs: records, chunks, chat text, tokenizers, samples."""

import sys

from pyspark import cloudpickle

# The Arrow functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
