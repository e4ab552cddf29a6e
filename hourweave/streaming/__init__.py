"""The same roll-ups, scores and publications as increments."""
