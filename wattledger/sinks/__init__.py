"""Writers. Every write replaces only its own partitions or appends once, so it can be repeated."""
