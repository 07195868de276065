"""Matching long lines along the fixed parts of a format.

A pattern that may match anywhere is tried at every character of a line, and what stands before the part that tells the format apart, like the host of
an access line, is read again from each of them.  In a long line of the right characters that takes time by the square of its length.  Here the part
itself, the anchor, is looked for first; what is left of it is cut into the words the pattern wants, from right to left; what is right of it is
matched once, from its beginning; and each piece is matched alone. Where all fit, the line is given to the pattern from the match's first character on.

The cut is the only one possible if the line holds the anchor once, and no field on its left may hold blanks.  Otherwise the whole pattern decides.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglathe.functions.patterns import CompiledPattern, compile_pattern

#: shorter lines take the whole pattern, which can't take long there
LONG_LINE = 512
#: an address is shorter than this, and starts at no more than one character before
_ADDRESS = 64
_LABEL = r"[0-9A-Za-z-]{0,62}[0-9A-Za-z]"
#: read backwards from its end: the labels of a host, as many as a name may have
_HOST_BACKWARDS = rf"^\.?(?:{_LABEL}\.){{0,126}}{_LABEL}"


@dataclass(frozen=True)
class Skeleton:
    """How a format's pattern is put together: a host, other words, each with a blank behind it, the anchor, and the rest."""

    host: str
    words: tuple[str, ...]
    anchor: str
    rest: str

    @property
    def template(self) -> str:
        return " ".join([self.host, *self.words, ""]) + self.anchor + self.rest

    @cached_property
    def right(self) -> CompiledPattern:
        return compile_pattern(self.anchor + self.rest)

    def count(self, line: Column) -> Column:
        return F.regexp_count(line, F.lit(compile_pattern(self.anchor).regex))

    def ambiguous(self, line: Column) -> Column:
        """Whether the whole pattern has to decide: the anchor comes more than once, or an address has a zone, which may hold blanks."""
        # the address as it is written out at the first use of the name, without its zone
        zone = compile_pattern("%{IPV6:x}").regex.removesuffix("(?:%.+)?)")
        return (self.count(line) > 1) | (F.contains(line, F.lit("%")) & line.rlike(zone + ")%"))

    def cut(self, line: Column) -> Column:
        """The line from where its match begins, ``''`` if it has none, and null if the whole pattern has to decide.

        The pattern then matches at the first character of what is left, so it isn't tried at any other.
        """
        at = F.regexp_instr(line, F.lit(compile_pattern(self.anchor).regex))
        left, right = F.substring(line, F.lit(1), at - 1), F.substring(line, at, F.length(line))
        n = len(self.words) + 1
        pieces = F.split(F.substring_index(left, " ", -(n + 1)), " ", -1)
        ours = [F.get(pieces, F.lit(i)) for i in range(n + 1)]
        host = F.regexp_extract(F.concat(_host_end(ours[0]), F.lit(" ")), f"^(?s:.*?)({compile_pattern(self.host).regex}) $", 1)
        good = (self.count(line) == 1) & (F.size(pieces) == n + 1) & (ours[n] == "")
        for word, template in zip(ours[1:n], self.words, strict=True):
            good &= word.rlike(f"^(?:{compile_pattern(template).regex})\\z")
        good &= right.rlike(f"^(?:{self.right.regex})") & (host != "")
        found = F.when(F.coalesce(good, F.lit(False)), F.concat_ws(" ", host, *ours[1:n], right)).otherwise("")
        return F.when(~self.ambiguous(line), found)


def _host_end(word: Column) -> Column:
    """The end of a word that a host name or an address in it can reach back to, and one character before it."""
    name = F.length(F.regexp_extract(F.reverse(word), _HOST_BACKWARDS, 0))
    return F.right(word, F.greatest(name + 1, F.lit(_ADDRESS)))


ACCESS = Skeleton(
    "%{BLANKHOST:clientip}",
    ("%{USER:ident}", "%{USER:auth}"),
    r'\[%{HTTPDATE:timestamp}\] "',
    r'(?:%{WORD:verb} %{NOTSPACE:request}(?: HTTP/%{NUMBER:httpversion})?|%{DATA:rawrequest})" %{NUMBER:response} (?:%{NUMBER:bytes}|-)',
)
AGENT = " %{QS:referrer} %{QS:agent}"
