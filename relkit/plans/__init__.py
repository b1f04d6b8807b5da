"""Join strategies, views and procedures."""
