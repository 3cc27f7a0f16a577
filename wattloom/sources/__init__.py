"""Reading, landing, merging and writing of lake tables."""
