"""Operators for preparing text corpora to train language models on.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface and the thin registered query over the given
tables; ``queries.registered()`` collects them.
"""
