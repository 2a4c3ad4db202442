"""DataFrame operators: dimensions, status, roll-up, runs and measures."""
