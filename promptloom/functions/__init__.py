"""Column functions: native Catalyst expressions only, no Python workers."""
