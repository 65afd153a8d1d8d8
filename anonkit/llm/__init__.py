"""Operators of a training-data pipeline: filters, duplicates, extraction, archives, search, tokens, packing.

Nothing else in the library imports this subpackage. The Python part of an operator runs inside
``mapInArrow`` or ``applyInPandas``; Spark partitions, shuffles and retries the work.
"""
