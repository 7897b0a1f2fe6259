"""The registered queries of this subpackage and their DuckDB SQL."""
from __future__ import annotations

from . import audit, bpe, exact, fingerprint, langid, mix, near, ngram, privacy, quality, rules, runs, shard

_MODULES = (exact, near, shard, ngram, langid, quality, bpe, privacy, fingerprint, mix, rules, audit, runs)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
