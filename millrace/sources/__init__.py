"""millrace sources."""
