"""velolake.plans."""
