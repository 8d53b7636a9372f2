"""The registered queries: library operators over the given tables, and their SQL counterparts."""
