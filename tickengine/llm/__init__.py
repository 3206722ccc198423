"""Operators of a training-data pipeline over the tables ``documents``, ``benchmark``, ``labels`` and ``embeddings``.

One module per operator, ``textkit`` and ``recurring`` shared by several, ``registry`` with the registered queries.
Nothing outside this folder imports it except the guarded import in ``__spark_entry__``.
"""
