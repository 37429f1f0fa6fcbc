"""velolake.sources."""
