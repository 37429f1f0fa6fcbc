"""velolake.sinks."""
