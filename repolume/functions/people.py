"""Stable pseudonyms for people, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repolume.fixed_values import PLACEHOLDER_LOGIN

# One word per hexadecimal digit.
ADJECTIVES = (
    "amber", "bold", "brisk", "calm", "clear", "crisp", "eager", "fair", "fresh", "gentle", "green", "keen", "kind",
    "noble", "quick", "quiet",
)
NOUNS = (
    "acorn", "alder", "aspen", "birch", "brook", "cedar", "cliff", "dune", "fern", "field", "glade", "harbor", "maple",
    "meadow", "ridge", "river",
)
HEX_DIGITS = "0123456789abcdef"


def _word(words: tuple[str, ...], digit: Column) -> Column:
    return F.get(F.array(*[F.lit(word) for word in words]), F.position(digit, F.lit(HEX_DIGITS)) - 1)


def pseudonym(node_id: Column, salt: str = "") -> Column:
    """Readable pseudonym that depends on ``node_id`` and ``salt`` only; NULL for NULL.

    Two words for people, 128 bits of the digest for uniqueness: it is used as a key, so two users must never
    share one. Being a pure function it needs no lookup table and is the same in every repository. Every part
    is NULL for NULL, so no branch keeps Spark from computing the digest once.
    """
    return _spelled(_digest(node_id, salt))


def _digest(node_id: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), node_id.cast("string")), 256)


def _spelled(digest: Column) -> Column:
    dash = F.lit("-")
    first, second = F.substring(digest, 1, 1), F.substring(digest, 2, 1)
    return F.concat(_word(ADJECTIVES, first), dash, _word(NOUNS, second), dash, F.substring(digest, 3, 32))


def real_user_id(user: Column) -> Column:
    """``node_id`` of a user struct; NULL for no user and for the placeholder account without a name."""
    placeholder = (user["login"] == PLACEHOLDER_LOGIN) & user["name"].isNull()
    return F.when(~F.coalesce(placeholder, F.lit(False)), user["node_id"])


class People:
    """How user structs become user columns.

    ``People(salt)`` writes pseudonyms, ``People(raw_ids=True)`` keeps the source ids, to be replaced through a
    stored users table later (``operators.lookups.replace_users``).
    """

    def __init__(self, salt: str = "", raw_ids: bool = False) -> None:
        self.salt = salt
        self.raw_ids = raw_ids

    def from_id(self, node_id: Column) -> Column:
        return node_id if self.raw_ids else pseudonym(node_id, self.salt)

    def one(self, user: Column) -> Column:
        return self.from_id(real_user_id(user))

    def several(self, users: Column) -> Column:
        """Ordered array of user columns; a user that is not known stays as a NULL element."""
        ids = F.transform(F.coalesce(users, F.array()), real_user_id)
        if self.raw_ids:
            return ids
        # in a lambda nothing is computed once for several uses, so the digests are an array of their own
        digests = F.transform(ids, lambda node_id: _digest(node_id, self.salt))
        return F.transform(digests, _spelled)
