"""Plan construction on the driver: header heuristics and the stages."""
