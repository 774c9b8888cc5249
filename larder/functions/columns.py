"""Column helpers shared by the operators."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_sum(value: Column) -> Column:
    """Exact sum of amounts to six places as a decimal, independent of task order.

    Six places hold price x quantity x (1 - percent / 100) without rounding. Whole units and
    millionths are summed as integers, which stays in generated code; decimals appear only in
    the result.
    """
    whole = F.floor(value)
    millionths = F.rint((value - whole) * 1000000).cast("bigint")
    return (F.sum(whole).cast("decimal(28,0)")
            + F.sum(millionths).cast("decimal(28,0)") * F.lit(Decimal("0.000001")))


def rounded(value: Column, places: int) -> Column:
    """Half-up rounding on the decimal value, returned as double.

    Four digits beyond the result are kept first, which drops the noise of double arithmetic.
    """
    return F.round(value.cast(f"decimal(38,{places + 4})"), places).cast("double")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def count_true(condition: Column) -> Column:
    return F.count_if(condition)


def percent_text(share: Column, places: int = 1) -> Column:
    """0.1234 as '12.3%'."""
    scaled = F.round(share.cast("decimal(18,6)") * 100, places).cast(f"decimal(20,{places})")
    return F.concat(scaled.cast("string"), F.lit("%"))


def decimal_text(value: Column, places: int) -> Column:
    """A number as text with a fixed count of decimals."""
    return F.round(value.cast("decimal(28,8)"), places).cast(f"decimal(24,{places})").cast("string")


def one_row(frame: DataFrame, *aggregates: Column) -> Column:
    """The one-row aggregate of ``frame`` as a struct usable inside another query."""
    return frame.agg(F.struct(*aggregates).alias("value")).scalar()
