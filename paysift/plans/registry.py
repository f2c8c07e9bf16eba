"""All survey queries and their SQL."""

from paysift.plans import oracle, queries, record_oracle, record_queries

QUERIES = {**queries.QUERIES, **record_queries.QUERIES}
ORACLE_SQL = {**oracle.ORACLE_SQL, **record_oracle.RECORD_SQL}
