"""Files and tables: what jobs read from and write to."""
