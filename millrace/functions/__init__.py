"""millrace functions."""
