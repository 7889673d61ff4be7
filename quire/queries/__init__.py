"""Registered queries of the core: name -> f(spark, sf_dir) -> DataFrame, and the SQL of the same name."""

from quire.queries import content, general, outline

_MODULES = (general, outline, content)
CORE_QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
CORE_SQL = {k: s for m in _MODULES for k, s in m.SQL.items()}
flagship = outline.section_tree
