"""Registered queries, their SQL counterparts and the inputs both read."""
