"""Writers: result CSV, period table, report lines."""
