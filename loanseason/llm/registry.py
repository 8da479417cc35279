"""All queries of this folder with the pipeline that is built from them."""

from __future__ import annotations

import corpus_pipeline
from loanseason.llm import oracles, queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLES = oracles.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
