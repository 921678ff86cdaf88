"""Operators for large training-data pipelines.

One module per operator (suffix_dedup, simhash, decontaminate, html_extract,
topk, bpe, url_filter, toxicity, line_dedup, sharding), `graph` for connected
components and `queries` for the registered `opN_*` queries.  Nothing else in
the library imports this subpackage.

Functions that run on Python workers are pickled by value, so executors need
no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
