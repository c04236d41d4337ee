"""Training-data operators: dedup, filtering, mixing, packing, archives.

Nothing outside this subpackage imports it; ``queries.py`` holds the
registered queries, ``corpus_pipeline.py`` (repository top) the pipeline.
"""
