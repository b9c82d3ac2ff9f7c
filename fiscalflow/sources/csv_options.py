"""One set of CSV options for every reader and writer of the library.

Blanks around values are kept, a quote inside a value is doubled, and an
empty text (``""``) is told apart from a null (nothing): Spark's reader makes
both null, so quoted empties are read as a marker and turned back into empty
text by ``restore_empties``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.functions._util import column

#: Stands for a quoted empty text between the reader and ``restore_empties`` (private-use characters).
EMPTY = "\uf8fe\uf8ff"

_BOTH = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": ""}


def reader_options(sep: str, encoding: str, header: bool, multiline: bool) -> dict[str, str]:
    return _BOTH | {"sep": sep, "encoding": encoding, "header": str(header).lower(), "multiLine": str(multiline).lower(), "mode": "PERMISSIVE", "emptyValue": EMPTY}


def writer_options(sep: str, encoding: str, header: bool) -> dict[str, str]:
    return _BOTH | {"sep": sep, "encoding": encoding, "header": str(header).lower(), "emptyValue": '""'}


def restore_empties(df: DataFrame) -> DataFrame:
    """Text columns with the marker of a quoted empty text turned into the empty text."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    own = {c: column(c) for c in df.columns}
    return df.select(*[F.when(own[c] == EMPTY, F.lit("")).otherwise(own[c]).alias(c) if c in text else own[c] for c in df.columns])
