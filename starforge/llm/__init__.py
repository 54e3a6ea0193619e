"""Operators of a training-data pipeline: quality rules, token counts, line
and exact dedup, language ID, BPE, n-gram Jaccard join, HTML extraction,
packing, URL filters, chat formatting, cross-tokenizer alignment and dataset
manifests.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLE`` hold the registered queries and their SQL.
"""
