"""Progress text of the ``ps`` report (F12–F16), as Column expressions.

Rounding rules are part of the contract:
* sizes use ``format_number`` (Java DecimalFormat, HALF_EVEN on the exact
  binary value — the same digits as Python's ``{:,.1f}``);
* the time-left number is rounded half-to-even (``bround``) before Java's
  ``%2.0f`` sees it, because Java rounds halves up and the reference prints
  with Python's ``%`` operator; its plural test rounds halves away from zero
  (``round``), as Python 2's ``round`` did.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]
TIME_UNITS = ["sec", "min", "hour", "day"]
TIME_STEPS = [60, 60, 24]
BAR_WIDTH_TOTAL = 50


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def human_size(num) -> Column:
    """``1,234.5 KB`` — divide by 1024 until below 1024, B … TB, else PB."""
    x = _col(num).cast("double")
    expr = None
    scaled = x
    for unit in SIZE_UNITS[:-1]:
        text = F.concat(F.format_number(scaled, 1), F.lit(" " + unit))
        expr = F.when(scaled < 1024.0, text) if expr is None else expr.when(scaled < 1024.0, text)
        scaled = scaled / 1024.0
    return expr.otherwise(F.concat(F.format_number(scaled, 1), F.lit(" " + SIZE_UNITS[-1])))


def _time_piece(value: Column, unit: str) -> Column:
    plural = F.when(F.round(value, 0) != 1.0, F.lit("s")).otherwise(F.lit(""))
    return F.format_string("%2.0f %s%s left", F.bround(value, 0), F.lit(unit), plural)


def time_left_text(seconds) -> Column:
    """−1 → ``estimating...``; else ``%2.f unit[s] left`` in sec/min/hour/day."""
    t = _col(seconds).cast("double")
    expr = F.when(t == -1, F.lit("estimating..."))
    scaled = t
    for unit, step in zip(TIME_UNITS, TIME_STEPS):
        expr = expr.when(scaled < step, _time_piece(scaled, unit))
        scaled = scaled / float(step)
    return expr.otherwise(_time_piece(scaled, TIME_UNITS[-1]))


def percent_done(current, total) -> Column:
    """F14 as a fraction: current / total, 0 when total is 0 (NULLs count 0)."""
    cur = F.coalesce(_col(current), F.lit(0)).cast("double")
    tot = F.coalesce(_col(total), F.lit(0)).cast("double")
    return F.when(tot == 0, F.lit(0.0)).otherwise(cur / tot)


def _pad_right(text: Column, width: int) -> Column:
    return F.rpad(text, F.greatest(F.lit(width), F.length(text)), " ")


def _pad_left(text: Column, width: int) -> Column:
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), " ")


def progress_bar(current, total, width: int = BAR_WIDTH_TOTAL) -> Column:
    """F14 + F15: ``12%  [==>    ]   1.0 KB/8.0 KB`` in ``width`` characters.

    When the numbers leave no room for a bar, only the numbers are returned.
    """
    cur = F.coalesce(_col(current), F.lit(0))
    tot = F.coalesce(_col(total), F.lit(0))
    frac = percent_done(cur, tot)
    pct = F.concat((frac * 100).cast("int").cast("string"), F.lit("%"))
    cur_s, tot_s = human_size(cur), human_size(tot)
    head = _pad_right(pct, 4)
    tail = F.concat(_pad_left(cur_s, 10), F.lit("/"), _pad_right(tot_s, 10))
    bare = F.concat(head, F.lit(" "), tail)
    bar_width = F.lit(width) - F.length(bare) - 3
    filled = (bar_width * frac).cast("int")
    arrow = F.when((filled != bar_width) & (frac != 0), F.lit(">")).otherwise(F.lit(""))
    bar = F.concat(F.repeat(F.lit("="), filled), arrow)
    boxed = F.concat(F.lit("["), F.rpad(bar, F.greatest(bar_width, F.length(bar)), " "), F.lit("]"))
    return F.when(bar_width <= 0, bare).otherwise(F.concat(head, F.lit(" "), boxed, F.lit(" "), tail))


def rate_text(rate) -> Column:
    """``{:>10}/s`` of the human size of a rate (NULL → 0)."""
    return F.concat(_pad_left(human_size(F.coalesce(_col(rate), F.lit(0))), 10), F.lit("/s"))


def time_left_cell(seconds) -> Column:
    """``{:>13}`` of the time-left text (NULL → −1)."""
    return _pad_left(time_left_text(F.coalesce(_col(seconds), F.lit(-1))), 13)


def tasks_fraction(done, total, digits) -> Column:
    """F16: ``{done:>w}/{total:<w} finished``; ``w`` is a Column or int."""
    w = digits if isinstance(digits, Column) else F.lit(int(digits))
    d = _col(done).cast("string")
    t = _col(total).cast("string")
    return F.concat(
        F.lpad(d, F.greatest(w, F.length(d)), " "), F.lit("/"),
        F.rpad(t, F.greatest(w, F.length(t)), " "), F.lit(" finished"),
    )
