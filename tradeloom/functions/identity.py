"""Card tokens, tax numbers with check digits, and repeatable draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_LENGTH = 32


def draw(key: Column, label: str, size: int) -> Column:
    """Repeatable whole number in [0, size) for a text key and a label.

    Taken from a hash of the row's own key, so rows can be made in any partition
    and again after a lost task with the same outcome.
    """
    digest = F.md5(F.concat(key, F.lit("/"), F.lit(label)))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") % size


def pick_weighted(weights: dict[str, int], key: Column, label: str) -> Column:
    """One of the values, each as likely as its weight."""
    drawn, bound, found = draw(key, label, sum(weights.values())), 0, F.lit(None)
    steps = []
    for value, weight in weights.items():
        bound += weight
        steps.append((bound, value))
    for bound, value in reversed(steps):
        found = F.when(drawn < bound, value).otherwise(found)
    return found


def pick(options: list[str], key: Column, label: str) -> Column:
    """One of the options, each with equal weight."""
    listed = F.array(*[F.lit(option) for option in options])
    return F.element_at(listed, (draw(key, label, len(options)) + 1).cast("int"))


def card_token(owner: Column, salt: Column) -> Column:
    """Opaque token of a card: part of the digest of owner and salt."""
    return F.substring(F.sha2(F.concat(owner, salt), 256), 1, TOKEN_LENGTH)


def _check_digit(weighted_sum: Column) -> Column:
    """Remainder by 11; below 2 gives 0, else 11 minus the remainder."""
    return (F.lit(11) - weighted_sum % 11) % 11 % 10


def cpf(nine_digits: Column) -> Column:
    """Tax number of eleven digits: nine given ones and two check digits.

    The first check digit weighs the digits 10..2. The second weighs them 11..3 and
    the first check digit 2.
    """
    digits = [F.substring(nine_digits, i, 1).cast("int") for i in range(1, 10)]

    def weighted(heaviest: int) -> Column:
        total = digits[0] * heaviest
        for step, digit in enumerate(digits[1:], start=1):
            total = total + digit * (heaviest - step)
        return total

    first = _check_digit(weighted(10))
    second = _check_digit(weighted(11) + first * 2)
    return F.concat(nine_digits, first.cast("string"), second.cast("string"))


def cpf_is_valid(number: Column) -> Column:
    """Eleven digits whose last two are the check digits of the others."""
    well_formed = number.rlike("^[0-9]{11}$")
    return F.when(well_formed, cpf(F.substring(number, 1, 9)) == number).otherwise(
        F.lit(False)
    )
