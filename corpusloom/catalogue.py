"""Every registered query of the library with its SQL."""

from __future__ import annotations

from .plans import admission, corpus, formats, frontend, language, scoring, words

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _plan in (corpus, language, scoring, frontend, formats, admission, words):
    QUERIES |= _plan.QUERIES
    ORACLES |= _plan.ORACLES

flagship = QUERIES["flagship_split"]
