"""Column-name cleaning, for schemas and for text columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that become "_" and characters that are removed.
TO_UNDERSCORE = " -"
REMOVED = "(){};=\n\t"
# Fixed value: what str.strip() takes for white space, as a regular expression's class.
BLANKS = r"\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

_NAME_TABLE = str.maketrans(TO_UNDERSCORE, "_" * len(TO_UNDERSCORE), REMOVED)


def clean_name(name: str) -> str:
    return name.strip().translate(_NAME_TABLE)


def clean_names(df: DataFrame) -> DataFrame:
    """Rename all columns at once; two names that fall together are an error."""
    names = [clean_name(name) for name in df.columns]
    clashes = sorted(name for name, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"column names are equal after cleaning: {clashes}")
    return df.toDF(*names)


def clean_text(text: Column) -> Column:
    """The same rule for values, e.g. names that arrive as data."""
    stripped = F.regexp_replace(text, rf"^[{BLANKS}]+|[{BLANKS}]+$", "")
    # translate() drops the characters that have no partner in the second list.
    return F.translate(stripped, TO_UNDERSCORE + REMOVED, "_" * len(TO_UNDERSCORE))
