"""Training-data operators: ten document and page operators and their queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
