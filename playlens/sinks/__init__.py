"""Document projection, JSON encoding and idempotent writers."""
