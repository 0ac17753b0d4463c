"""Plans over event frames: projection, ranges, rollups, retention, hour calendar."""
