"""Operators for building language-model training corpora.

A self-contained subpackage: nothing else in the library imports it. Each
module holds one operator with its own general interface; ``queries.py`` binds
them to the driver tables and ``corpus_pipeline.py`` (repository top) chains
five of them.
"""
