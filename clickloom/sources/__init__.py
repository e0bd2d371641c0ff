"""Export files, the accumulated event store and output tables."""
