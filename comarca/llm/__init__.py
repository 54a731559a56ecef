"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it.  Each operator module exposes a
general function over any DataFrame; :mod:`comarca.llm.queries` derives the
digest columns of the registered ``opN_<name>`` queries from them.
"""
