"""millrace plans."""
