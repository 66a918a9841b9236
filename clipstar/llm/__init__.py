"""Operators of a training-data pipeline: PII, quality, language-model scores, WARC archives, near and exact
duplicates, packing, URL filters, language identification, benchmark decontamination, phrase collocations, near
duplicates among embeddings and hard negatives.

Nothing outside this package imports it.  Each operator module holds one operator with its own general
interface; ``queries`` registers the thin ``opN_<name>`` queries over the given tables.
"""
