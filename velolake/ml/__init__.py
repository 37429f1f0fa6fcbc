"""velolake.ml."""
