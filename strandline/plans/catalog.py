"""All queries of the core, by name, with the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.plans import checks, curation, exposures, identities, records, resemblance, texts

_PARTS = (curation.query, exposures.query, texts.query, identities.query, checks.query, resemblance.query)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = records.QUERIES | {k: f for p in _PARTS for k, f in p.queries.items()}
ORACLES: dict[str, str] = records.ORACLES | {k: q for p in _PARTS for k, q in p.oracles.items()}
FLAGSHIP = "q_cascade_counts"
