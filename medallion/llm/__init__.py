"""Operators of a training-data pipeline, one module each; nothing outside
this subpackage (and ``corpus_pipeline.py``) imports them."""
