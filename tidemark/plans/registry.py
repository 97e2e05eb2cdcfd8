"""Every query of the engine by name, and the DuckDB SQL that gives the same rows."""

from . import captions, corpora, files, histories, labels

QUERIES, ORACLES = {}, {}
for _module in (histories, corpora, captions, labels, files):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
