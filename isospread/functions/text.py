"""Text helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIR_SEPARATOR = "_"
KEY_SEPARATOR = "&&"


def case_name(fname: Column, left: str, right: str) -> Column:
    """Text between the first ``left`` and the next ``right``; raises without ``left``.

    Delimiters are literal. When ``right`` is missing, everything after ``left`` is the name.
    """
    parsed = F.split_part(F.split_part(fname, F.lit(left), F.lit(2)), F.lit(right), F.lit(1))
    return F.when(F.contains(fname, F.lit(left)), parsed).otherwise(
        F.raise_error(F.concat(F.lit(f"file name without {left!r}: "), fname))
    )


def case_number(case: Column) -> Column:
    """Member number: the last three characters."""
    return F.right(case, F.lit(3))


def parse_kwargs_column(text: Column) -> Column:
    """``k&&v_k&&v`` to a map. The last duplicate key wins; a malformed pair raises."""
    def add(found: Column, pair: Column) -> Column:
        parts = F.split(pair, KEY_SEPARATOR)
        key = F.when(F.size(parts) == 2, parts[0]).otherwise(
            F.raise_error(F.concat(F.lit("malformed key/value pair: "), pair))
        )
        others = F.map_filter(found, lambda k, _: k != key)
        return F.map_concat(others, F.create_map(key, parts[1]))

    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(F.split(F.upper(text), PAIR_SEPARATOR), empty, add)


def parse_kwargs(text: str) -> dict[str, str]:
    """Driver-side form of :func:`parse_kwargs_column`, for one options string."""
    pairs = [pair.split(KEY_SEPARATOR) for pair in text.upper().split(PAIR_SEPARATOR)]
    bad = [KEY_SEPARATOR.join(p) for p in pairs if len(p) != 2]
    if bad:
        raise ValueError(f"malformed key/value pairs: {bad}")
    return dict(pairs)
