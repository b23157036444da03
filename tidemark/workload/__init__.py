"""The queries of the driver contract: each operator on the given tables, with its SQL counterpart."""
