"""Small text helpers for the SQL oracles (DuckDB dialect)."""


def rnd(expr: str, digits: int = 2) -> str:
    """DuckDB twin of ``round_half_up``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"
