"""Operators for building training corpora: dedup, PII, tokenizing, packing, language, sharding, chat, fingerprints.

Nothing outside this subpackage imports it.  ``queries.py`` registers one
query per operator; ``__spark_entry__.py`` adds them when the subpackage is
present.
"""
