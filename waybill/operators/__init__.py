"""Table-to-table operators composed of built-in DataFrame operations."""
