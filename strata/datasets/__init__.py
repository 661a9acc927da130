"""Dataset declarations (schemas, sources, partition keys)."""
