"""sources of the text-pair engine."""
