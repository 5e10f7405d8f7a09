"""Corpus preparation for language-model training: thirteen operators over the
``documents``, ``embeddings`` and ``pages`` tables.

Nothing outside this subpackage imports it; its queries are listed in
:mod:`scoreline.llm.registry`.
"""
