"""String and regular-expression columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions.columns import col

# Allowed image extensions, and the characters that count as white space in text.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "webp")
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = r"\s\x1c-\x1f\x85\p{Z}"
WORD_CLASS = r"\p{L}\p{N}_"


def strip_ws(c: Column | str) -> Column:
    """Remove all white space at both ends (a plain ``trim`` removes blanks only)."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def split_to_columns(df: DataFrame, c: str, sep: str, names: Sequence[str]) -> DataFrame:
    """One column per part; null where a row has fewer parts."""
    parts = F.split(F.col(c), "\\Q" + sep + "\\E", -1)
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(names)})


def cat_with_na(prefix: Column, rest: Sequence[Column | str], sep: str, na_rep: str) -> Column:
    """Concatenate; a null prefix nulls the result, a null part is shown as ``na_rep``."""
    pieces = [prefix]
    for part in rest:
        pieces += [F.lit(sep), F.coalesce(col(part), F.lit(na_rep))]
    return F.concat(*pieces)


def find_all(c: Column | str, pattern: str) -> Column:
    """All matches of a pattern as an array."""
    return F.regexp_extract_all(col(c), F.lit(pattern), F.lit(0))


def first_number(c: Column | str, kind: str = "double") -> Column:
    """First run of digits and dots as a number, null where there is none."""
    return F.regexp_extract(col(c), r"[0-9.]+", 0).try_cast(kind)


def clean_money_text(c: Column | str) -> Column:
    """Price text without the mis-decoded character; null becomes empty."""
    return strip_ws(F.replace(F.coalesce(col(c), F.lit("")), F.lit("Â"), F.lit("")))


def slug(c: Column | str, maxlen: int = 80, default: str = "untitled") -> Column:
    """File-name slug: word characters only, runs of blanks, underscores and hyphens become one hyphen."""
    kept = F.regexp_replace(col(c), f"[^{WORD_CLASS}{SPACE_CLASS}-]+", "")
    joined = F.btrim(F.regexp_replace(kept, f"[{SPACE_CLASS}_-]+", "-"), F.lit("-"))
    return F.coalesce(F.nullif(F.substring(joined, 1, maxlen), F.lit("")), F.lit(default))


def plain_slug(c: Column | str, maxlen: int = 120, default: str = "unknown") -> Column:
    """Looser slug: each blank becomes one hyphen, nothing is collapsed."""
    kept = strip_ws(F.regexp_replace(F.coalesce(col(c), F.lit("")), f"[^{WORD_CLASS}{SPACE_CLASS}-]+", ""))
    dashed = F.replace(kept, F.lit(" "), F.lit("-"))
    return F.coalesce(F.nullif(F.substring(dashed, 1, maxlen), F.lit("")), F.lit(default))


def url_path(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def image_extension(c: Column | str, default: str = "jpg") -> Column:
    """Allowed image extension of a URL path; jpeg counts as jpg, anything else as the default."""
    ext = F.lower(F.regexp_extract(url_path(c), r"\.([^.]*)$", 1))
    return (
        F.when(ext == "jpeg", "jpg").when(ext.isin(*IMAGE_EXTENSIONS), ext).otherwise(F.lit(default))
    )


def file_stem(c: Column | str) -> Column:
    """File name without folder and last extension."""
    name = F.regexp_extract(col(c), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


@F.pandas_udf(StringType())
def absolute_url(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Resolve links against the URL of their page."""
    for base, link in parts:
        yield pd.Series([
            None if b is None or r is None else _join(b, r) for b, r in zip(base, link, strict=True)
        ], dtype=object)


def _join(base: str, link: str) -> str | None:
    try:
        return urljoin(base, link)
    except ValueError:
        return None


def record_parts(df: DataFrame, c: str, sep: str, names: Sequence[str]) -> DataFrame:
    """Split records on a separator and keep those with exactly the expected number of parts."""
    parts = F.split(F.col(c), "\\Q" + sep + "\\E", -1)
    return (
        df.withColumn("__parts", parts)
        .filter(F.size("__parts") == len(names))
        .withColumns({name: F.col("__parts")[i] for i, name in enumerate(names)})
        .drop("__parts")
    )
