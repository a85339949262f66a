"""Frame-to-frame operators, generic in table, key and order."""
