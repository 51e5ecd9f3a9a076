"""From options to schema and scan tasks."""
