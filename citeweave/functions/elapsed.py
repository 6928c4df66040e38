"""Human-readable durations for logs, and as a Column."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_elapsed(seconds: float) -> str:
    whole = int(seconds)
    hours, minutes, rest = whole // 3600, whole % 3600 // 60, whole % 60
    if hours:
        return f"{hours}h {minutes}m {rest}s"
    if minutes:
        return f"{minutes}m {rest}s"
    return f"{seconds:.3f}s"


def elapsed(milliseconds: Column) -> Column:
    """format_elapsed of a column of whole milliseconds."""
    part = lambda unit, cycle: F.floor(milliseconds / unit) % cycle
    hours, minutes, rest = F.floor(milliseconds / 3_600_000), part(60_000, 60), part(1000, 60)
    return (
        F.when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, rest))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, rest))
        .otherwise(F.format_string("%d.%03ds", rest, milliseconds % 1000))
    )
