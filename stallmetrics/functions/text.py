"""Text normalisation as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values -- these must equal the published ones for equal results.
COLUMN_FOLD = ("ğüşıöç", "gusioc")
MOJIBAKE_FIXES = [
    ("Ä°", "I"),
    ("Ä±", "i"),
    ("Ã", "A"),
    ("Ã¼", "u"),
    ("Ã¶", "o"),
    ("Ã§", "c"),
    ("Å", "S"),
    ("ÄŸ", "g"),
    ("0STANBUL", "ISTANBUL"),
]
DIACRITICS = ("ğĞüÜşŞıİöÖçÇ", "gGuUsSiIoOcC")
CATEGORY_KEYWORDS = [
    ("Gül", ["gül", "gul", "rose"]),
    ("Orkide", ["orkide", "orkid"]),
    ("Papatya", ["papatya"]),
    ("Lilyum", ["lilyum", "lilium"]),
    ("Gerbera", ["gerbera"]),
    ("Lisyantus", ["lisyantus", "lisianthus"]),
    ("Karanfil", ["karanfil"]),
    ("Lale", ["lale", "tulip"]),
]
DEFAULT_CATEGORY = "Karma/Diğer"
# End of fixed values.


def fold_column_names(df: DataFrame) -> DataFrame:
    """Replace lower-case Turkish letters in column names (metadata only, no job)."""
    table = str.maketrans(*COLUMN_FOLD)
    return df.toDF(*[name.translate(table) for name in df.columns])


def canonical_city(col: Column) -> Column:
    """Collapse the spellings of the two halves of Istanbul; other text is unchanged."""
    shout = F.upper(col)
    in_city = shout.contains("ISTANBUL")
    return (
        F.when(in_city & shout.contains("AVRUPA"), F.lit("ISTANBUL-AVRUPA"))
        .when(in_city & shout.contains("ANADOLU"), F.lit("ISTANBUL-ANADOLU"))
        .otherwise(col)
    )


def normalize_turkish(col: Column) -> Column:
    """Trim, undo broken encodings in the published order, drop diacritics, fix cities.

    ``Ã`` is repaired before the two-letter sequences that start with it, so those
    never match; the order is part of the contract.
    """
    trimmed = F.regexp_replace(col, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    repaired = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), MOJIBAKE_FIXES, trimmed)
    plain = F.translate(repaired, *DIACRITICS)
    return F.replace(canonical_city(plain), F.lit("  "), F.lit(" "))


def name_contains(col: Column, keyword: str) -> Column:
    """Case-insensitive keyword test; null or empty text is false."""
    return F.coalesce(F.lower(col).contains(keyword.lower()), F.lit(False))


def detect_category(col: Column, rules=None, default: str = DEFAULT_CATEGORY) -> Column:
    """Label of the first rule with a keyword inside the lower-cased name."""
    rules = CATEGORY_KEYWORDS if rules is None else rules
    lowered = F.lower(col)
    arms = [
        (reduce(lambda a, b: a | b, [lowered.contains(word) for word in words]), label)
        for label, words in rules
    ]
    first, *rest = arms
    chain = reduce(lambda acc, arm: acc.when(arm[0], F.lit(arm[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(default))


def _fold_lower(col: Column) -> Column:
    return F.translate(F.lower(col), *COLUMN_FOLD)


def site_slug_underscore(col: Column) -> Column:
    """Lower-case site name with spaces as underscores and Turkish letters folded."""
    return F.replace(_fold_lower(col), F.lit(" "), F.lit("_"))


def site_slug_compact(col: Column) -> Column:
    """Lower-case site name without white space, Turkish letters folded."""
    return F.regexp_replace(_fold_lower(col), r"\s+", "")


def name_slug(col: Column) -> Column:
    """Lower-case name, every other run of characters as one dash, outer dashes trimmed."""
    return F.regexp_replace(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-"), "^-|-$", "")


def date_part(col: Column) -> Column:
    """Date of an ISO datetime text; text that is no date becomes null."""
    return F.when(col.contains("T"), F.split(col, "T").getItem(0)).otherwise(col).try_cast("date")


def joined_list(col: Column) -> Column:
    """List as one comma-separated text; a missing element prints as ``None``."""
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ", ", "None")
