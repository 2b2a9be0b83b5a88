"""Training-data operators: fingerprints, dedup, PII, mixing, tokenization and
the other stages of a document corpus pipeline, each as a Spark job."""
import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that a job runs
# wherever Python and its libraries do, with nothing installed or shipped beforehand.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
