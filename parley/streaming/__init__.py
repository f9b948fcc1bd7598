"""The same turn measures over an unbounded input."""
