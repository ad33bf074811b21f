"""Reference statements for a second engine (DuckDB), one per registered query."""
