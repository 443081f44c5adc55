"""Operators for large training corpora (documents, pages, embeddings).

Nothing else in the package imports this subpackage.  Each module holds one
operator with its own interface; :mod:`tidewatch.llm.queries` derives the
registered digest queries from them.
"""
