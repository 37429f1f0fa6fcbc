"""velolake.functions."""
