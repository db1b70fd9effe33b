"""Relational operators over change events: filters, collapse, application to targets, batching, schema evolution, state."""
