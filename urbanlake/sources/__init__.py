"""Input readers: raw sensor CSV (batch and stream) and the test-table views."""
