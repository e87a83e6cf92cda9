"""operators of the text-pair engine."""
