"""Named queries of the engine and the helpers they share."""
