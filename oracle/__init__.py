"""Independent DuckDB SQL oracle: every builder as a CTE, every query key as SQL."""
