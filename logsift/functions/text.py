"""Text expressions (JVM-side except NFKD, which has no Spark built-in)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.contracts import MAX_MESSAGE_LENGTH

# Python's str.split() whitespace set, written as a Java regex class:
# \s (space, \t \n \x0B \f \r) + Unicode separators + \x85 + \x1c-\x1f.
WS_CLASS = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"
# Unicode category C* except newline and tab.
CONTROL_CLASS = r"[\p{C}&&[^\n\t]]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """Runs of whitespace -> one space, ends trimmed (H1)."""
    return F.trim(F.regexp_replace(_col(c), WS_CLASS + "+", " "))


def strip_control(c) -> Column:
    """Drop control/format/private-use/unassigned characters but \\n, \\t (H2)."""
    return F.regexp_replace(_col(c), CONTROL_CLASS, "")


def truncate(c, n: int = MAX_MESSAGE_LENGTH) -> Column:
    """First n code points (H4)."""
    return F.substring(_col(c), 1, n)


def _nfkd_batch(a: pa.Array) -> pa.Array:
    import pyarrow.compute as pc
    return pc.utf8_normalize(a, form="NFKD")


_nfkd_udf = F.arrow_udf(_nfkd_batch, T.StringType())


def nfkd(c) -> Column:
    """NFKD normalisation (H3): ASCII text is already NFKD and goes to Python as null."""
    x = _col(c)
    return F.coalesce(_nfkd_udf(F.when(~is_ascii(x), x)), x)


def standardise_text(c, max_length: int | None = None, do_truncate: bool = True,
                     unicode_normalise: bool = True) -> Column:
    """NFKD -> strip control -> collapse whitespace -> truncate -> trim (H5).

    Whole texts by default; ``max_length`` asks for the cut (H4)."""
    x = _col(c)
    if unicode_normalise:
        x = nfkd(x)
    x = collapse_ws(strip_control(x))
    if do_truncate and max_length is not None:
        x = truncate(x, max_length)
    return F.trim(x)


def clean_text_no_nfkd(c, max_length: int | None = None) -> Column:
    """H2 -> H1 -> H4 if a length is given -> trim, all JVM-side (what H5 is on NFKD-stable text)."""
    x = collapse_ws(strip_control(_col(c)))
    return F.trim(x if max_length is None else truncate(x, max_length))


def preview(c, n: int = 200) -> Column:
    """First n characters plus '...' when longer."""
    x = _col(c)
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


def first_present(*cols, default: str | None = None) -> Column:
    """First non-null of several columns, then a default."""
    parts = [_col(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def changed(old, new) -> Column:
    """True when before and after differ, nulls compared as values."""
    return ~_col(old).eqNullSafe(_col(new))


def is_ascii(c) -> Column:
    return ~_col(c).rlike(r"[^\x00-\x7F]")


def register_functions(spark) -> None:
    """Expose ``nfkd`` and ``standardise_text`` (H3, H5) to SQL, the latter as a SQL function over the built-ins."""
    spark.udf.register("nfkd", _nfkd_udf)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION standardise_text(t STRING) RETURNS STRING RETURN
                  trim(regexp_replace(regexp_replace(nfkd(t), r'{CONTROL_CLASS}', ''), r'{WS_CLASS}+', ' '))""")
