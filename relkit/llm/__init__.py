"""Operators for preparing large training corpora, one module each, and
the queries that apply them (:mod:`relkit.llm.queries`).  Nothing outside
this subpackage imports it."""
