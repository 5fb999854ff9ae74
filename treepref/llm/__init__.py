"""Operators for large training-data pipelines.

Each module holds one operator with its own general interface (DataFrame in,
DataFrame out); ``queries.py`` registers the thin ``opN_<name>`` queries.
Nothing outside this subpackage imports it, apart from ``__spark_entry__.py``
behind a guard and ``corpus_pipeline.py``.
"""
