"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  Each module holds one operator with a
general interface; :mod:`rankloom.llm.queries` registers one query per operator.
"""
