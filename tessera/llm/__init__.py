"""Training-data operators on Spark.

The functions these modules send to Python workers are pickled by value, so that a cluster whose
workers don't have this package installed runs them all the same.
"""

import importlib

from pyspark import cloudpickle

MODULES = (
    "scratch", "components", "url_filter", "kd_shards", "radix_dedup", "bpe", "mixing", "multi_index",
    "line_dedup", "bag_minhash", "suffix_dedup", "toxicity", "pii", "prefix_trie", "spelling",
)

for _name in MODULES:
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_name}"))
