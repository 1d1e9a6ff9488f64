"""Rules, search indexes and import jobs."""
