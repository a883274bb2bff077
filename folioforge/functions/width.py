"""Width and ignorable characters, on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Full-width forms are the printable ASCII characters shifted by a fixed distance.
FULL = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)) + "　"
HALF = "".join(map(chr, range(0x21, 0x7F))) + " "
IGNORABLE = "[\\x{00AD}\\x{200B}-\\x{200F}\\x{2060}\\x{FE00}-\\x{FE0F}\\x{FEFF}]"


def full_to_half(c: Column) -> Column:
    """Full-width letters, digits, marks and the ideographic blank as ASCII; null stays null."""
    return F.translate(c, FULL, HALF)


def strip_ignorables(c: Column) -> Column:
    """Without characters that leave no mark."""
    return F.regexp_replace(c, IGNORABLE, "")
