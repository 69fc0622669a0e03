"""SQL admission, audit, capacity and operations."""
