"""millrace streaming."""
