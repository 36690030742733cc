"""Plain SQL counterparts of the registered queries, for DuckDB."""

from .loads import LOADS
from .marts import MARTS
from .quality import QUALITY

ORACLE = {**LOADS, **MARTS, **QUALITY}
