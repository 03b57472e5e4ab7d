"""Training-data operators: one module per operator, plus their queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
``queries.QUERIES`` and ``queries.ORACLES`` hold what the entry module adds.
"""
