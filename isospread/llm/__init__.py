"""Operators of a training-data pipeline: mixing, scoring, search, de-duplication and extraction.

The modules share two helpers. ``words`` finds and hashes the words of many texts at once;
``exchange`` lets blocks of documents ask questions of the whole corpus. Executors must be able
to import this package (ship it with ``--py-files`` where it is not installed).
"""
