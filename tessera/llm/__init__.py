"""Operators for large training-data pipelines: decontamination, deduplication,
filtering, tokenisation and search over corpora of documents."""
