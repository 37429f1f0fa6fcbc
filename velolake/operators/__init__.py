"""velolake.operators."""
