"""Session set-up, the named query registry and the SQL twins used as correctness oracle."""
