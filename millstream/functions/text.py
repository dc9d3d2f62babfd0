"""Column functions on text and bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what separates the words of the word-count job.
NON_LETTERS = r"[^a-zA-Z]+"

# The characters that str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_all(c: Column | str) -> Column:
    """Drop white space of every kind at both ends, line ends included."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def split_fields(c: Column | str, separator: str = ",") -> Column:
    """The fields of a delimited line; the separator is taken literally."""
    return F.split(_col(c), f"\\Q{separator}\\E")


def field(fields: Column | str, position: int) -> Column:
    """One field by 0-based position; NULL when the line is too short."""
    return F.get(_col(fields), F.lit(position))


def fields_after(fields: Column | str, position: int) -> Column:
    """The fields behind a 0-based position, as an array."""
    fields = _col(fields)
    return F.slice(fields, position + 2, F.greatest(F.size(fields) - position - 1, F.lit(0)))


def words(c: Column | str) -> Column:
    """Array of the words of a text: split on non-letters. Only the empty strings at
    its ends can be something else than a solid word, so only these are left out."""
    return F.array_remove(F.split(_col(c), NON_LETTERS), "")


def join_fields(separator: str, *cols: Column | str) -> Column:
    """The columns as text with a separator between them; a NULL reads as empty."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.concat_ws(separator, *parts)


def pair_text(*cols: Column | str, types: tuple[str, ...] | None = None) -> Column:
    """A record in tuple notation, such as ``('STR_2', 216)``.

    ``types`` says per column whether it is ``"str"`` (quoted) or ``"num"``;
    without it the first column is text and the others are numbers.
    """
    types = types or ("str",) + ("num",) * (len(cols) - 1)
    parts: list[Column] = []
    for i, (c, kind) in enumerate(zip(cols, types, strict=True)):
        if i:
            parts.append(F.lit(", "))
        text = _col(c).cast("string")
        parts += [_quoted(text)] if kind == "str" else [F.coalesce(text, F.lit("None"))]
    if len(cols) == 1:
        parts.append(F.lit(","))
    return F.concat(F.lit("("), *parts, F.lit(")"))


def _quoted(text: Column) -> Column:
    """Text in quotes: double ones only when it holds a single quote and no double one."""
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    body = F.replace(body, F.lit("\n"), F.lit("\\n"))
    body = F.replace(body, F.lit("\r"), F.lit("\\r"))
    body = F.replace(body, F.lit("\t"), F.lit("\\t"))
    has_single = F.contains(text, F.lit("'"))
    has_double = F.contains(text, F.lit('"'))
    return (
        F.when(text.isNull(), F.lit("None"))
        .when(has_single & ~has_double, F.concat(F.lit('"'), body, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def to_bytes(c: Column | str) -> Column:
    return F.encode(_col(c), "UTF-8")


def from_bytes(c: Column | str) -> Column:
    return F.decode(_col(c), "UTF-8")


def encode_record(*cols: Column | str, separator: str = ":") -> Column:
    """Fields of a record as bytes, for display and exchange; as a grouping key the
    struct itself is better."""
    return to_bytes(join_fields(separator, *cols))


def decode_record(c: Column | str, names: Sequence[str], separator: str = ":") -> Column:
    """The struct of text fields behind such bytes; the last field may hold separators."""
    parts = F.split(from_bytes(c), f"\\Q{separator}\\E", len(names))
    return F.struct(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
