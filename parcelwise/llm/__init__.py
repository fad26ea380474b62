"""Operators for building training data: quality, language models, token counts, decontamination and more.

Nothing else in the library imports this subpackage. Each module is one operator with its own general interface;
:mod:`parcelwise.llm.queries` binds them to the standard tables.
"""
