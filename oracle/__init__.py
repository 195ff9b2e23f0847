"""DuckDB SQL that recomputes the registered queries from the given tables."""
