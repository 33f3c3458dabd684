"""Table readers, stand-in views and sinks."""
