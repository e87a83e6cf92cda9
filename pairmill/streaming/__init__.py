"""streaming of the text-pair engine."""
