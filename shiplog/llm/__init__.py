"""Corpus operators for training-data pipelines (deduplication, search,
decontamination, language-model scoring, filtering, packing, extraction).

Nothing else in the library imports this subpackage.
"""
