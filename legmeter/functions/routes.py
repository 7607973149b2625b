"""Encoded routes: text to coordinates and time offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Encoded-route alphabet, precision and offset unit.
CHAR_OFFSET = 63
COORDINATE_SCALE = 1e7
OFFSET_BASE = 36
OFFSETS_PER_SECOND = 20
OFFSET_SEPARATOR = ";"
OFFSET_PIECE = r"^[+-]?[0-9A-Za-z]+$"
# Characters that end a number, and those after which it goes on.
LAST_CHARS = r"\?-\^"
MORE_CHARS = r"_-~"
BASE_32 = "0123456789abcdefghijklmnopqrstuv"
# A step between two points of the earth needs 33 bits, which are seven characters.
LONGEST_NUMBER = 7
# Entries of a block of running sums, a power of two.
BLOCK = 16


def route_points(text: Column) -> Column:
    """The points of an encoded route; null if the text is null or damaged.

    Every character carries five bits, low bits first, and a flag for "more to come". The numbers are steps of latitude
    and longitude in turn, the sign in the lowest bit, so running sums give the points. Characters that start no whole
    pair at the end of a route are dropped. A damaged route has a character outside the alphabet or a number too long for a
    coordinate. A number is read at once, as digits of base 32.
    """
    marked = F.regexp_replace(text, f"([{LAST_CHARS}])", "$1 ")
    digits = F.split(F.translate(marked, "".join(map(chr, range(CHAR_OFFSET, CHAR_OFFSET + 64))), BASE_32 * 2), " ", -1)
    sound = ~text.rlike(f"[^{LAST_CHARS}{MORE_CHARS}]") & ~text.rlike(f"[{MORE_CHARS}]{{{LONGEST_NUMBER}}}[{MORE_CHARS}]*[{LAST_CHARS}]")

    def step(number: Column) -> Column:
        bits = F.conv(F.reverse(number), 32, 10).cast("long")
        half = F.shiftright(bits, 1)
        return F.when(bits % 2 == 1, -1 - half).otherwise(half)

    def points(pieces: Column) -> Column:
        # What follows the last whole number is none.
        return _named(running_sums(F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), step), 2), _pairs)

    return F.when(sound, _named(digits, points))


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pairs(sums: Column) -> Column:
    count = F.floor(F.size(sums) / 2).cast("int")
    points = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct((F.get(sums, 2 * i) / COORDINATE_SCALE).alias("lat"), (F.get(sums, 2 * i + 1) / COORDINATE_SCALE).alias("lon")),
    )
    return F.when(count > 0, points).otherwise(F.array().cast("array<struct<lat:double,lon:double>>"))


def running_sums(values: Column, stride: int = 1) -> Column:
    """For each entry the sum of it and every ``stride``-th entry before it.

    Sums run inside blocks first, then over the last sums of the blocks, which are added to the blocks after. In each
    round of both every entry adds the sum that ends ``reach`` entries before, then the reach doubles. The work grows with
    the length; appending one sum after the other would copy the array each time.
    """

    def reaching(sums: Column, power: Column, block: int | None) -> Column:
        reach = F.call_function("shiftleft", F.lit(stride), power)
        return F.transform(
            sums, lambda value, i: value + F.when((i if block is None else i % (block * stride)) >= reach, F.get(sums, i - reach)).otherwise(0)
        )

    def whole(sums: Column) -> Column:
        rounds = F.greatest(F.ceil(F.log2(F.greatest(F.size(sums), F.lit(1)))).cast("int") - 1, F.lit(0))
        return F.aggregate(F.sequence(F.lit(0), rounds), sums, lambda done, power: reaching(done, power, None))

    wide = BLOCK * stride

    def joined(inner: Column) -> Column:
        ends = F.filter(inner, lambda _, i: i % wide >= wide - stride)
        return _named(whole(ends), lambda ahead: F.transform(inner, lambda value, i: value + F.when(i >= wide, F.get(ahead, F.floor(i / wide).cast("int") * stride + i % stride - stride)).otherwise(0)))

    rounds = F.sequence(F.lit(0), F.lit(BLOCK.bit_length() - 2))
    inner = F.aggregate(rounds, values, lambda done, power: reaching(done, power, BLOCK))
    return _named(inner, lambda sums: F.when(F.size(sums) <= wide, sums).otherwise(joined(sums)))


def route_offsets(text: Column) -> Column:
    """``;``-separated base-36 offsets to seconds; an empty piece is null, an empty text is null."""

    def seconds(piece: Column) -> Column:
        digits = F.regexp_replace(piece, "^[+-]", "")
        size = F.conv(digits, OFFSET_BASE, 10).cast("double") / OFFSETS_PER_SECOND
        return F.when(piece.rlike(OFFSET_PIECE), F.when(piece.startswith("-"), -size).otherwise(size))

    return F.when(text != "", F.transform(F.split(text, OFFSET_SEPARATOR, -1), seconds))
