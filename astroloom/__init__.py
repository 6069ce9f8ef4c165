"""Sky-survey analytics on Spark: tiles, cross-matches, cutouts, pixel statistics."""
