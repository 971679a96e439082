"""Operators for preparing large text corpora (deduplication, filtering, tokenising, packing).

Every operator takes a DataFrame of documents with at least ``doc_id`` and ``text`` and reads
only the columns it names, so any other column may be present under any other name. A null text
counts as an empty text and a null ``doc_id`` is an ordinary value that sorts after all others.
Nothing outside this subpackage imports it.
"""
