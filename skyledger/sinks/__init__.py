"""Published tables: artifacts, state rows and versioned releases."""
