"""Event, archive, lake and synthetic sources."""
