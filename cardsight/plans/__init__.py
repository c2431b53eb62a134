"""Query registry (``catalog``) and the oracle SQL that checks it (``oracle_sql``)."""
