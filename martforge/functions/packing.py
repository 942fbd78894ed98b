"""Several small values of a row in one long, without loss: such rows cross a shuffle narrow.

A row's columns are replaced by words of 64 bits. Shuffle files compress rows
byte by byte, and a row of full words costs them a third less than the same
values in columns of 8 bytes with a few used. A row with a value that does not
fit its bits, or is null, keeps all of its columns as they are (a struct, null
elsewhere), so every value comes back as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

class Form(NamedTuple):
    """How a value is a whole number: ``code`` of a column, and its ``value`` in the column's type again."""

    code: Callable[[Column], Column]
    value: Callable[[Column, str], Column]


WHOLE = Form(lambda c: c.try_cast("bigint"), lambda n, kind: n.cast(kind))
#: Doubles that are whole hundredths (prices, rates).
HUNDREDTHS = Form(lambda c: F.rint(c * F.lit(100.0)).try_cast("bigint"), lambda n, kind: (n / F.lit(100.0)).cast(kind))
#: Times at the start of a day.
DAYS = Form(lambda c: F.unix_date(F.to_date(c)).cast("bigint"),
            lambda n, kind: F.date_from_unix_date(n.cast("int")).cast(kind))


def units(scale: int) -> Form:
    """Decimals of that scale, in units of their last digit."""
    return Form(lambda c: F.round(c * F.lit(10 ** scale)).try_cast("bigint"),
                lambda n, kind: (n.cast("decimal(20,0)") * F.expr(f"{10 ** -scale:.{scale}f}BD")).cast(kind))


class Field(NamedTuple):
    """A column in ``bits`` bits of a word, from 0 or, ``signed``, from minus half their range."""

    form: Form
    bits: int
    signed: bool = False

    @property
    def least(self) -> int:
        return -(1 << self.bits - 1) if self.signed else 0


#: Word -> column -> field; at most 64 bits a word.
Words = dict[str, dict[str, Field]]


def rest(words: Words) -> str:
    """The column that keeps what does not fit into ``words``."""
    return f"{next(iter(words))}_rest"


def _fields(df: DataFrame, words: Words) -> list[tuple[str, str, Field, int, str]]:
    """(word, column, field, first bit, type) of every packed column."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for word, fields in words.items():
        at = 0
        for column, field in fields.items():
            out.append((word, column, field, at, kinds[column]))
            at += field.bits
        if at > 64:
            raise ValueError(f"{word} has {at} bits")
    return out


def _fits(c: Column, field: Field, kind: str) -> Column:
    """The value comes back from its code as it is (a negative zero would not)."""
    n = field.form.code(c)
    same = (n >= field.least) & (n < field.least + (1 << field.bits)) & (field.form.value(n, kind) == c)
    return same & F.when(c == 0, ~c.cast("string").startswith("-")).otherwise(True) if kind in ("double", "float") else same


def pack(df: DataFrame, words: Words) -> DataFrame:
    """What does not fit (``rest``) and the words first, then the columns that are in no word."""
    fields = _fields(df, words)
    fit = F.coalesce(reduce(Column.__and__, (_fits(F.col(c), f, kind) for _, c, f, _, kind in fields)), F.lit(False))
    bits = {w: reduce(Column.bitwiseOR, (F.shiftleft(f.form.code(F.col(c)) - f.least, at) for v, c, f, at, _ in fields if v == w))
            for w in words}
    packed = [c for _, c, _, _, _ in fields]
    return df.select(F.when(~fit, F.struct(*packed)).alias(rest(words)), *[F.when(fit, b).alias(w) for w, b in bits.items()],
                     *[c for c in df.columns if c not in packed])


def unpack(df: DataFrame, words: Words, like: DataFrame) -> DataFrame:
    """The columns that ``pack`` of ``like`` put into words, in place of them."""
    back = {}
    for word, column, field, at, kind in _fields(like, words):
        n = F.shiftrightunsigned(F.col(word), at).bitwiseAND(F.lit((1 << field.bits) - 1).cast("bigint")) + F.lit(field.least)
        back[column] = F.when(F.col(rest(words)).isNull(), field.form.value(n, kind)).otherwise(
            F.col(f"{rest(words)}.{column}"))
    return df.withColumns(back).drop(rest(words), *words)
