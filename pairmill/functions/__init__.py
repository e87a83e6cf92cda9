"""functions of the text-pair engine."""
