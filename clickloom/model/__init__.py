"""The DeepFM click model: network arithmetic, scoring, training and search.

Batch functions run in Python workers; they travel with the job, so the executors need
only numpy and pyarrow.
"""

from pyspark import cloudpickle

from clickloom.model import network

cloudpickle.register_pickle_by_value(network)
