"""DataFrame-to-DataFrame operators on grids, tables and cell metadata."""
