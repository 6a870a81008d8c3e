"""Operators of a training-data pipeline, one module each.

Nothing outside this subpackage imports it. Registered queries are in
:mod:`logwise.llm.queries`, their DuckDB oracles in ``ORACLES`` there.
"""
