"""Log lines: fixed layout ``date | level | thread | class:line | message``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Most severe level first, and the level range each sink accepts.
LEVELS = ("FATAL", "ERROR", "WARN", "INFO", "DEBUG", "TRACE")
SINKS = {
    "DATA": ("FATAL", "INFO"),
    "ERROR": ("FATAL", "ERROR"),
    "WARN": ("WARN", "WARN"),
    "ALL": ("FATAL", "DEBUG"),
}

FIELD_BAR = r"\s*\| "
DATE_HEAD = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3} \| "
LEVEL_NAME = r"^\w+$"
CALLER = r"^(.*?):(\d+)$"


def format_line(ts: Column, level: Column, thread: Column, cls: Column, line: Column, msg: Column) -> Column:
    """One line in the layout; fields are cut or padded to 5, 10, 20 and 5 characters.

    A field that is too long keeps its last characters.
    """

    def fixed(value, width):
        return F.rpad(F.right(value, F.lit(width)), width, " ")

    return F.concat_ws(
        " | ",
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"),
        fixed(level, 5),
        fixed(thread, 10),
        F.concat(fixed(cls, 20), F.lit(":"), fixed(line.cast("string"), 5)),
        msg,
    )


def level_rank(level: Column) -> Column:
    """0 for FATAL up to 5 for TRACE; NULL for anything else."""
    position = F.array_position(F.array(*[F.lit(name) for name in LEVELS]), F.upper(level))
    return F.when(position > 0, (position - 1).cast("int"))


def accepting_sinks(level: Column) -> Column:
    """Names of the sinks whose level range takes the line."""
    rank = level_rank(level)
    accepted = [
        F.when(rank.between(LEVELS.index(first), LEVELS.index(last)), F.lit(sink))
        for sink, (first, last) in SINKS.items()
    ]
    return F.array_compact(F.array(*accepted))
