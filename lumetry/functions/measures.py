"""Sums and means that come out the same whatever the order in which partitions are added up.

Fractional readings are added as the decimals the sender wrote, not as binary fractions, so 0.1 + 0.2 is 0.3 and a
stream, a batch and a roll-up of either agree to the last digit. A reading is added in one of four ways:

- `hundredths`: up to two decimals and below `HUNDREDTHS_BELOW`, as nearly all readings; integers, which is fast;
- `sum`: up to six decimals, by way of its text;
- `fine`: up to eighteen decimals and below 10^6, by way of its text;
- `rest`: what none of these holds unchanged (1e-30, 10^12 and up, NaN, infinity), as a double.

So no reading is rounded before it is added: a decimal takes a reading only if it gives the same reading back.

The order of doubles can show in the last digit of their sum. A float measure with `any_float` adds those readings as
whole numbers, too: every float is a sum of at most two digits to the base of 2^48, one sum is kept for each of the six
places there are, and `rest` only has what is no number. That is exact from the least float to the greatest, in any order.

A measure is kept as these sums and the count `n`; unlike means, they add up across windows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

READING = "decimal(18,6)"
TOTAL = "decimal(28,6)"
FINE = "decimal(24,18)"
FINE_TOTAL = "decimal(34,18)"
# The places of an `any_float` sum: digits to the base of 2^PLACE_BITS, of which the first counts units of 2^-UNIT_BITS.
PLACES, PLACE_BITS, UNIT_BITS = 6, 48, 149
DIGITS = "decimal(30,0)"
# Keeps the integer sum of 9 * 10^11 readings in one group below the limit of a BIGINT.
HUNDREDTHS_BELOW = 100_000


def unchanged(value: str, kind: str, decimal: str = READING) -> str:
    """SQL for a float or double as the decimal it is written as; NULL where that would change it."""
    written = f"try_cast(cast({value} AS string) AS {decimal})"
    return f"CASE WHEN cast({written} AS {kind}) = {value} THEN {written} END"


def exact(value: str, kind: str = "double") -> str:
    """SQL for a float or double as the decimal it is written as, of up to eighteen places; NULL where none holds it."""
    return f"coalesce(cast({unchanged(value, kind)} AS {FINE_TOTAL}), {unchanged(value, kind, FINE)})"


class Measure(NamedTuple):
    """A reading to sum up. `kind` is its type, `float` or `double`, or None for integers."""

    name: str
    column: str
    kind: str | None = None
    any_float: bool = False

    @property
    def parts(self) -> dict[str, str]:
        """Columns that hold the partial sums, and their types."""
        types = {"sum": "BIGINT", "n": "BIGINT"}
        if self.kind:
            types = {"hundredths": "BIGINT", "sum": TOTAL, "fine": FINE_TOTAL, "rest": "DOUBLE", "n": "BIGINT"}
            if self.any_float:
                types |= {f"place_{k}": DIGITS for k in range(PLACES)}
        return {f"{self.name}_{part}": kind for part, kind in types.items()}

    def _split(self) -> tuple[str, str, str, str]:
        """SQL for a reading in each of the four ways, NULL in all but one: hundredths, sum, fine, rest."""
        value = f"`{self.column}`"
        hundredths = f"try_cast(rint(double({value}) * 100) AS bigint)"
        short = f"(abs({value}) < {HUNDREDTHS_BELOW} AND cast({hundredths} / 100D AS {self.kind}) = {value})"
        other = f"CASE WHEN NOT {short} THEN {value} END"
        six = unchanged(other, self.kind)
        more = f"CASE WHEN {six} IS NULL THEN {other} END"
        fine = unchanged(more, self.kind, FINE)
        return f"CASE WHEN {short} THEN {hundredths} END", six, fine, f"CASE WHEN {fine} IS NULL THEN double({more}) END"

    def prepared(self, readings: DataFrame) -> tuple[DataFrame, str | None]:
        """The readings with what is left of each one for the places of an `any_float` sum, and the column that holds it.

        Give its name to `partials`: the seven sums that need it then read it, where they would work it out each.
        """
        if not (self.kind and self.any_float):
            return readings, None
        left = f"{max(readings.columns, key=len)}_left"
        return readings.withColumn(left, F.expr(self._split()[3])), left

    def partials(self, left: str | None = None) -> list[Column]:
        """Aggregates over readings, or over those that are `prepared`."""
        value = f"`{self.column}`"
        sums = [f"sum({value})", f"count({value})"]
        if self.kind:
            *decimals, rest = self._split()
            sums = [*(f"sum({part})" for part in (*decimals, rest)), f"count({value})"]
            if self.any_float:
                finite = "abs({r}) < double('infinity')"
                parts = [f"if({finite}, NULL, {{r}})", *(f"if({finite}, {_digit('{r}', k)}, NULL)" for k in range(PLACES))]
                if left:
                    parts = [part.format(r=f"`{left}`") for part in parts]
                else:  # as the argument of a lambda, what is left of a reading is worked out once for each sum
                    parts = [f"transform(array({rest}), r -> {part.format(r='r')})[0]" for part in parts]
                sums[3], *places = (f"sum({part})" for part in parts)
                sums += places
        return [F.expr(total).alias(part) for total, part in zip(sums, self.parts, strict=True)]

    def merged(self) -> list[Column]:
        """Aggregates over partial sums, of the same names and types."""
        return [F.expr(f"cast(sum({part}) AS {kind})").alias(part) for part, kind in self.parts.items()]

    def total(self, digits: int | None = None) -> Column:
        """The sum, rounded half up if `digits` is given."""
        if not self.kind:
            return F.col(f"{self.name}_sum")
        return F.expr(self._settled(lambda decimal: decimal, self._double(), digits))

    def mean(self, digits: int = 2) -> Column:
        """The mean of the readings that are present, rounded half up."""
        n = f"{self.name}_n"

        def mean(decimal: str) -> str:
            return f"try_divide({decimal}, cast({n} AS decimal(20,0)))"

        if not self.kind:
            return F.expr(f"double(round({mean(self._coarse())}, {digits}))")
        return F.expr(self._settled(mean, f"({self._double()}) / {n}", digits))

    def _coarse(self) -> str:
        """The sum of what has up to six decimals."""
        total = f"{self.name}_sum"
        if not self.kind:
            return f"cast({total} AS {TOTAL})"
        hundredths = f"cast({self.name}_hundredths AS decimal(20,0)) * 0.01BD"
        return f"cast(coalesce({hundredths} + coalesce({total}, 0), {total}) AS {TOTAL})"

    def _fine(self) -> str:
        """The sum of all decimals; NULL without finer ones, and where they vanish beside a sum of 10^19 or more."""
        return f"(try_cast(coalesce({self._coarse()}, 0) AS decimal(37,18)) + {self.name}_fine)"

    def _double(self) -> str:
        decimal = f"coalesce(double({self._fine()}), double({self._coarse()}), 0D)"
        if not self.any_float:
            return f"{decimal} + {self.name}_rest"
        places = [f"coalesce(double({self.name}_place_{k}), 0D) * {2.0 ** (PLACE_BITS * k - UNIT_BITS)!r}D" for k in range(PLACES)]
        # From the greatest place down, and the decimals where they belong: whole numbers cancel before that.
        return f"{' + '.join(reversed(places))} + {decimal} + coalesce({self.name}_rest, 0D)"

    def _decimal_only(self) -> str:
        return " AND ".join([f"{self.name}_rest IS NULL", *(f"{self.name}_place_{k} IS NULL" for k in range(PLACES * self.any_float))])

    def _settled(self, shape: Callable[[str], str], double: str, digits: int | None) -> str:
        """The decimal result, or the double one if a reading had to be added as a double."""
        coarse, fine = shape(self._coarse()), shape(self._fine())
        if digits is not None:
            coarse, fine, double = (f"round({value}, {digits})" for value in (coarse, fine, double))
        decimal = f"coalesce(double({fine}), double({coarse}))"
        return f"CASE WHEN {self._decimal_only()} THEN {decimal} ELSE {double} END"


def _digit(value: str, place: int) -> str:
    """SQL for one digit, with the sign, of a finite float as a double; every step is exact."""

    def above(k: int) -> str:  # without the digits below the k-th; from 2^53 on a double is a whole number
        scaled, whole = f"(abs({value}) * {2.0 ** (UNIT_BITS - PLACE_BITS * k)!r}D)", f"{2.0 ** 53!r}D"
        return f"if({scaled} < {whole}, double(floor(least({scaled}, {whole}))), {scaled})"

    higher = f" - {2.0 ** PLACE_BITS!r}D * {above(place + 1)}" if place + 1 < PLACES else ""
    return f"cast(sign({value}) * ({above(place)}{higher}) AS decimal(20,0))"


METER_MEASURES = (
    Measure("watt", "P (watt)"),
    Measure("volt", "V (volt)"),
    Measure("amphere", "I (amphere)", "float"),
)
COST = Measure("cost", "COST", "float")
ANY_COST = Measure("cost", "COST", "float", any_float=True)
