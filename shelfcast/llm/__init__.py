"""Training-data operators: ten Spark jobs over documents, pages and benchmark texts.

Each operator lives in a module of its own with a general interface; the thin
registered queries that derive contract digests from it are in ``queries.py``
and their DuckDB SQL in ``oracle.py``.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""
