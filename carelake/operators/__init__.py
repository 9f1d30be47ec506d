"""Generic DataFrame operators: dedupe, upsert/SCD2, lookups, checks."""
