"""Every query over the driver's tables by name, and DuckDB SQL for its rows."""

from __future__ import annotations

from lithos.plans import corpus, derived, models, more, relational, tables

QUERIES = corpus.QUERIES | relational.QUERIES | models.QUERIES | more.QUERIES | derived.QUERIES | tables.QUERIES
ORACLE = corpus.ORACLE | relational.ORACLE | models.ORACLE | more.ORACLE | derived.ORACLE | tables.ORACLE
