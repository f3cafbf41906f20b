"""Stand-ins for models, for tests and benchmarks only."""
