"""All registered queries and their SQL checks."""

from __future__ import annotations

from stayspark.plans import booking_flow, messaging, relational, sli_queries, stream_queries, text_queries, vector_queries

FAMILIES = [relational.REG, booking_flow.REG, messaging.REG, text_queries.REG, sli_queries.REG, vector_queries.REG, stream_queries.REG]

QUERIES = {name: run for reg in FAMILIES for name, run in reg.queries.items()}
ORACLES = {name: sql for reg in FAMILIES for name, sql in reg.oracles.items()}
