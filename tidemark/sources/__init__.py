"""Raw tables, CSV loading, lookup data and mart storage."""
