"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_label(name: Column | str) -> Column:
    """A borough name as used in file names: blanks become underscores."""
    return F.replace(F.col(name) if isinstance(name, str) else name, F.lit(" "), F.lit("_"))
