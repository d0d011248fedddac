"""Corpus operators for training-data pipelines, one module per operator.

Nothing else in the package imports this subpackage; the entry module adds
its queries (``minelake.llm.queries``) only when it can be imported.
"""
