"""End-to-end jobs and the registry of checked queries."""
