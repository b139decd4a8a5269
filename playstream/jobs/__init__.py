"""Programs to submit; each takes arguments only."""
