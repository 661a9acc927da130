"""Readers and writers: landed JSON pages, files, versioned slice tables, catalog."""
