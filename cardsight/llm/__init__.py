"""Training-data operators: ten large-corpus operators, each in a module of its own.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
