"""The registered queries: inputs derived from the given tables, and the SQL they are checked against."""
