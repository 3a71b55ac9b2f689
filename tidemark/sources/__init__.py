"""Landing readers and table writers."""
