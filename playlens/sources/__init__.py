"""Table, fixture, stream and history sources."""
