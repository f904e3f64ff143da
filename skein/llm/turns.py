"""Conversations as paths of turn digests: the common first step of the prefix operators.

A turn is named by 22 characters of its MD5 (role length, role, text); a path is the
digests of a conversation's turns written one after the other.  All digests have one
width, so the order of paths as strings is the order of the turn sequences: a prefix
sorts before what extends it, and conversations that share initial turns lie side by
side.  A conversation is one unit of work, as a document is elsewhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of a turn's name: the 128 bits of an MD5 in base 64 without padding.
WIDTH = 22

WORD = r"[^\x20\x09-\x0D]+"


def turn_digest(role: Column, text: Column) -> Column:
    """The name of a turn; the role's length keeps role and text apart."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.base64(F.unhex(F.md5(whole))), 1, WIDTH)


def path_of(digests: Column) -> Column:
    return F.array_join(digests, "")
