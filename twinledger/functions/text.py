"""List lines, error texts and markers inside free text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the header fields that carry an id inside document text. The names
# differ between archives, so every operator takes them as an argument.
SOURCE_MARKER = "X-SOURCE-ID"
ENTITY_MARKER = "X-REPORTING-ENTITY"

_CONTROL_AND_BLANK = "".join(chr(c) for c in range(0x21))


def java_trim(line: Column) -> Column:
    """Strip every character up to U+0020 from both ends, tabs included."""
    return F.btrim(line, F.lit(_CONTROL_AND_BLANK))


def first_column(line: Column) -> Column:
    """First column of a list line, leniently.

    No escapes inside quotes; a line with a leading comma or an unclosed quote
    stays whole.
    """
    closing = F.locate('"', line, 2)
    comma = F.instr(line, ",")
    quoted = F.when(closing > 0, F.substring(line, F.lit(2), closing - 2)).otherwise(line)
    plain = F.when(comma > 1, F.substring(line, F.lit(1), comma - 1)).otherwise(line)
    return F.when(line.startswith('"'), quoted).otherwise(plain)


def safe_error(message: Column) -> Column:
    return F.coalesce(F.translate(message, '"\n', "' "), F.lit(""))


# Characters that a table name cannot hold.
UNSAFE_IN_NAME = "[^A-Za-z0-9_]"


def sanitize_entity(entity: Column) -> Column:
    """The entity as part of a table name."""
    return F.regexp_replace(entity, UNSAFE_IN_NAME, "_")


def classify(n: Column) -> Column:
    return F.when(n == 0, "zero").when(n == 1, "unique").otherwise("duplicate")


def marker_pattern(marker: str) -> str:
    """Not part of a longer name, and with its value on the same line.

    The literal comes first, which lets the engine search for it as a string; what
    stands before it is looked at only where it was found.
    """
    name = re.escape(marker) + ":"
    return name + r"(?<![A-Za-z0-9_-]" + name + r")[ \t]*(\S+)"


def extract_marker(content: Column, marker: str = SOURCE_MARKER) -> Column:
    """Distinct values following 'marker:' anywhere in the text.

    A value ends at the next blank, so abc-1 is never found inside abc-12.
    """
    return F.array_distinct(F.regexp_extract_all(content, F.lit(marker_pattern(marker)), F.lit(1)))


def is_submitted(status: Column, body: Column) -> Column:
    """A delivery counts only on 2xx and a body that says so."""
    return F.coalesce(
        status.between(200, 299) & F.contains(F.lower(body), F.lit("submitted")), F.lit(False)
    )
