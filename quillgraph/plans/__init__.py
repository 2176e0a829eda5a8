"""Graph model, queries and analytics."""
