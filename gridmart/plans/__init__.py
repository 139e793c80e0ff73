"""The tables: Silver, Gold, their checks, the reports, and the full rebuild."""
