"""Column-expression helpers.  All of them build JVM-side expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens import config as C

MARGIN_TYPE = "decimal(28,9)"  # scale of the warehouse NUMERIC the marts were written for;
# 19 integer digits leave room for sums without hitting the 38-digit cap


def ws_trim(c: Column | str) -> Column:
    """Trim every Unicode White_Space character from both ends (Spark's plain
    ``trim`` removes only U+0020).  ``btrim`` with a character set needs no regex, but
    looks every character up in the set: texts that begin and end with a visible ASCII
    character, as most do, are left as they are."""
    c = (F.col(c) if isinstance(c, str) else c).cast("string")
    visible = F.ascii(c).between(0x21, 0x7E) & F.ascii(F.substring(c, -1, 1)).between(0x21, 0x7E)
    return F.when(visible, c).otherwise(F.btrim(c, F.lit(C.UNICODE_WHITESPACE)))


MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def month_name(d: Column) -> Column:
    """As ``date_format(d, 'MMMM')``, without a formatter per row."""
    return F.element_at(F.array(*map(F.lit, MONTHS)), F.month(d))


def exact_ratio(num: Column, den: Column, scale: int = 9, operand_type: str = "decimal(20,4)") -> Column:
    """num / den as a decimal rounded half-up to ``scale`` digits.

    Operands are narrowed first: Spark sizes a decimal quotient from the operand
    precisions and, past 38 digits, cuts its scale (two decimal(38,4) give only
    6 digits).  Two decimal(20,4) give 18, so the final rounding is the only one
    that matters."""
    return (num.cast(operand_type) / den.cast(operand_type)).cast(f"decimal(28,{scale})")


def days_between(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` as bigint."""
    return F.datediff(later, earlier).cast("bigint")


def severity_rank(sev: Column | str) -> Column:
    """CRITICAL 0, HIGH 1, MEDIUM 2, LOW 3, anything else 4."""
    s = F.col(sev) if isinstance(sev, str) else sev
    expr = F.lit(len(C.SEVERITY_ORDER))
    for name, rank in sorted(C.SEVERITY_ORDER.items(), key=lambda kv: -kv[1]):
        expr = F.when(s == name, F.lit(rank)).otherwise(expr)
    return expr


def emoji_for(sev: Column | str) -> Column:
    s = F.col(sev) if isinstance(sev, str) else sev
    expr = F.lit(C.DEFAULT_EMOJI)
    for name, emo in C.SEVERITY_EMOJI.items():
        expr = F.when(s == name, F.lit(emo)).otherwise(expr)
    return expr


def fmt_grouped(x: Column, digits: int) -> Column:
    """Like Python's ``format(x, ',.Nf')``: comma groups, half-even rounding of
    the binary double (``format_number`` uses java DecimalFormat, which does the same)."""
    return F.format_number(x.cast("double"), digits)


def fmt_fixed(x: Column, digits: int) -> Column:
    """Like Python's ``format(x, '.Nf')`` (no grouping)."""
    return F.regexp_replace(F.format_number(x.cast("double"), digits), ",", "")


def indian_grouping(x: Column) -> Column:
    """Whole-number text with Indian digit groups: 1,00,000 and 1,23,45,678."""
    r = F.round(x.cast("decimal(38,4)"), 0).cast("decimal(38,0)")
    digits = F.abs(r).cast("string")
    grouped = F.regexp_replace(digits, r"(\d)(?=(\d\d)+\d$)", "$1,")
    return F.when(r < 0, F.concat(F.lit("-"), grouped)).otherwise(grouped)
