"""End-to-end presets and cross-cutting plan helpers (skew, scratch, cache)."""
