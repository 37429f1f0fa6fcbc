"""velolake.streaming."""
