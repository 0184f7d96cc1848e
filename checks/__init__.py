"""Independent checks: DuckDB SQL equivalents of the named queries."""
