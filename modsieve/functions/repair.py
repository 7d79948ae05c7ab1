"""Repair of text whose UTF-8 bytes were read in a single-byte code page, in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modsieve.functions.text import rewrite_matches

# The characters of the code page windows-1252 for the bytes 80 to 9F, in order, without its five gaps.
MARKS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
BYTES = "".join(chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))

# A lead byte and its continuation bytes, as characters.
_LATE = rf"[\x{{80}}-\x{{BF}}{MARKS}]"
_MARK = rf"[\x{{80}}-\x{{9F}}{MARKS}]"
_ANY = rf"(?:[\x{{C2}}-\x{{DF}}]{_LATE}|[\x{{E0}}-\x{{EF}}]{_LATE}{_LATE}|[\x{{F0}}-\x{{F4}}]{_LATE}{_LATE}{_LATE})"
# Alone these are hardly ever meant: Latin letters, punctuation, the byte order mark, emoji.
_SURE = rf"(?:[\x{{C2}}\x{{C3}}]{_LATE}|[\x{{C4}}\x{{C5}}](?![‘’“”»›]){_LATE}|â{_MARK}{_LATE}|ï»¿|ðŸ{_LATE}{_LATE})"
WRONG = rf"{_ANY}{{2,}}|{_SURE}"
_HINT = rf"[\x{{C2}}-\x{{F4}}]{_LATE}"


def _decoded(run: Column) -> Column:
    """The run's bytes in the code page as UTF-8, or the run itself if they are none."""
    plain = F.translate(run, MARKS, BYTES)
    text = F.encode(plain, "ISO-8859-1").cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(run)


def repair_decoding(col: Column, passes: int = 2) -> Column:
    """``col`` with wrongly decoded runs restored; each pass undoes one wrong reading.

    A run is a sequence of characters that stand for well-formed UTF-8 in windows-1252 (or Latin-1). Two
    or more coded characters in a row are taken for a run; a single one only where it gives a
    Latin letter, punctuation or an emoji, so that a quoted capital or ``é »`` with a hard space stay. The
    restored text is always shorter. Other text stays byte for byte.
    """
    for _ in range(passes):
        # Bound to a name: a pass reads its text several times, which must not repeat the pass before.
        col = F.transform(F.array(col), lambda c: rewrite_matches(c, WRONG, _decoded, hint=lambda t: t.rlike(_HINT)))[0]
    return col


def damage_decoding(col: Column) -> Column:
    """What reading the UTF-8 bytes of ``col`` as windows-1252 makes of it."""
    return F.translate(F.decode(col.cast("binary"), "ISO-8859-1"), BYTES, MARKS)
