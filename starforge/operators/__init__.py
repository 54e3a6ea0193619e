"""DataFrame → DataFrame operators of the warehouse (staging, quality, SCD, lookups, facts,
measures, time intelligence, archive, tables, reconciliation, security, run log, monitoring)."""
