"""Files, topics, payload text and the catalog."""
