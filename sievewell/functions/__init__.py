"""Column-level helpers and the grouped exact quantile operator."""
