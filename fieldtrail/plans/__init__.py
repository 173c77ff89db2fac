"""Multi-operator plans: staging views, marts and the per-database sync."""
