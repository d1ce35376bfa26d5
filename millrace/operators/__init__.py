"""millrace operators."""
