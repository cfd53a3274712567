"""Named queries over the driver's tables, and their SQL."""

from . import queries_affix, queries_files, queries_report, queries_text

_MODULES = (queries_text, queries_affix, queries_report, queries_files)
QUERIES: dict = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES: dict = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
