"""The batch operators under Structured Streaming, with idempotent commits."""
