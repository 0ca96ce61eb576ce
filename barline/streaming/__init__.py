"""File-stream loads into the bar tables."""
