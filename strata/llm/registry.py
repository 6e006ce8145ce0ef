"""All registered document queries and their checking SQL, the pipeline included."""

import corpus_pipeline
from strata.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLES = queries.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
