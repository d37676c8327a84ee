"""Row fingerprint: SHA-256 over normalised business columns, as SQL text and as a ``Column``.

A value that does not fit its kind is hashed as its plain text, so rows that differ in it keep different keys. NULLs
are left out of the hashed text. ``null_token`` hashes a marker for NULLs instead, so that ``(NULL, '1')`` and
``('1', NULL)`` differ; that form does not match fingerprints made without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.schemas import FINGERPRINT

# How each kind is turned into text before hashing, and the text between two columns.
NORMAL_FORMS = {
    "int": "coalesce(string(try_cast({0} as bigint)), string({0}))",
    "ts": "date_format({0}, 'yyyy-MM-dd HH:mm:ss')",
    "dec": "coalesce(string(try_cast({0} as decimal(12,2))), string({0}))",
    "str": "string({0})",
}
SEPARATOR = "||"


def resolve(df: DataFrame, spec: Sequence[tuple[str, str]], missing: str = "skip") -> list[tuple[str, str]]:
    """Match the listed columns to those of ``df`` without regard to case, as Spark resolves names.

    Columns that ``df`` lacks are left out (``missing='skip'``) or reported (``missing='error'``).
    """
    present = {c.lower(): c for c in df.columns}
    absent = [name for name, _ in spec if name.lower() not in present]
    if absent and missing == "error":
        raise ValueError(f"fingerprint columns not found: {', '.join(absent)}")
    return [(present[name.lower()], kind) for name, kind in spec if name.lower() in present]


def fingerprint_sql(
    df: DataFrame,
    spec: Sequence[tuple[str, str]] = FINGERPRINT,
    null_token: str | None = None,
    missing: str = "skip",
    binary: bool = False,
) -> str:
    """Spark SQL text for the lower-case hex SHA-256 of the columns of ``df`` that ``spec`` lists.

    ``binary`` gives its 32 bytes instead, half of what the digits take in a shuffle; ``lower(hex(...))`` spells them.
    """
    parts = [NORMAL_FORMS[kind].format(f"`{name}`") for name, kind in resolve(df, spec, missing)]
    if null_token is not None:
        token = null_token.replace("\\", "\\\\").replace("'", "\\'")
        parts = [f"coalesce({p}, '{token}')" for p in parts]
    # never NULL: saying so spares joins and filters on the key a NULL test that would hash every row twice
    digits = f"sha2(concat_ws('{SEPARATOR}', {', '.join(parts)}), 256)"
    return f"coalesce(unhex({digits}), X'')" if binary else f"coalesce({digits}, '')"


def fingerprint(
    df: DataFrame,
    spec: Sequence[tuple[str, str]] = FINGERPRINT,
    null_token: str | None = None,
    missing: str = "skip",
    binary: bool = False,
) -> Column:
    """The same fingerprint as a ``Column``; both forms come from one definition."""
    return F.expr(fingerprint_sql(df, spec, null_token, missing, binary))
