"""Row-level building blocks, composed as SQL expressions."""
