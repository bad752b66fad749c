"""Cross-cutting plan helpers: session, shared folder, skew, query registry."""
