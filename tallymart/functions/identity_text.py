"""Folding of names for comparison: Unicode decomposition has no built-in function, so this one is a vectorised UDF."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Arabic letter variants and what they fold to.
ARABIC = {"أ": "ا", "إ": "ا", "آ": "ا", "ٱ": "ا", "ة": "ه", "ى": "ي", "ـ": ""}
_FOLD = str.maketrans(ARABIC)


def fold(value: str | None) -> str | None:
    """Marks dropped, letters folded and lower case, '&' spelt out, everything else a single blank; null if nothing is left."""
    if value is None:
        return None
    kept = "".join(c for c in unicodedata.normalize("NFKD", value) if unicodedata.category(c)[0] != "M")
    kept = kept.translate(_FOLD).lower().replace("&", " and ")
    return " ".join("".join(c if unicodedata.category(c)[0] in "LN" else " " for c in kept).split()) or None


@F.pandas_udf(StringType())
def identity_text(values: pd.Series) -> pd.Series:
    return values.map(fold, na_action="ignore")
