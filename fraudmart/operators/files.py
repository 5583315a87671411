"""Daily drop files: pick the oldest file per feed, skip files already ingested.

Works on a *listing* DataFrame with a ``name`` column (see
:func:`fraudmart.sources.listing.list_drop_files`), so the choice is a grouped
aggregate, not a driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.schemas import FEED_PREFIXES

# The date stamp inside a drop file name is the first run of eight
# digits followed by a dot, read as day, month, year.
NAME_DATE_PATTERN = r"(\d{8})\."
NAME_DATE_FORMAT = "ddMMyyyy"


# What tells one drop file from another.
FILE_KEY = ("name", "length", "modified")


class MissingFeedError(FileNotFoundError):
    """No drop file for a feed (H8)."""


def feed_of(name: Column, prefixes: dict[str, str] = FEED_PREFIXES) -> Column:
    """The feed a file belongs to, by name prefix (F11); NULL for other files."""
    expr = F.lit(None).cast("string")
    for feed, prefix in reversed(list(prefixes.items())):
        expr = F.when(name.startswith(prefix), F.lit(feed)).otherwise(expr)
    return expr


def drop_date(name: Column) -> Column:
    """The ``ddMMyyyy`` date in a file name.

    A name without the stamp fails the job with the name in the message (H8);
    ``regexp_extract`` returns ``''`` then, which must never parse as a date.
    """
    digits = F.regexp_extract(name, NAME_DATE_PATTERN, 1)
    return F.when(digits != F.lit(""), F.to_date(digits, NAME_DATE_FORMAT)).otherwise(
        F.raise_error(F.concat(F.lit("drop file name has no ddMMyyyy stamp: "), name)).cast("date")
    )


def oldest_drop(files: DataFrame, prefixes: dict[str, str] = FEED_PREFIXES, more: tuple[str, ...] = ()) -> DataFrame:
    """Per feed, the file with the smallest name date; ties by name.

    ``min(struct(date, name))`` is a partial aggregate, so the listing is never
    gathered in one place.  Output: ``feed, name, drop_date`` and the file's columns ``more``.
    """
    tagged = files.select("name", *more, feed_of(F.col("name"), prefixes).alias("feed")).where(F.col("feed").isNotNull())
    dated = tagged.select("feed", "name", *more, drop_date(F.col("name")).alias("drop_date"))
    best = dated.groupBy("feed").agg(F.min(F.struct("drop_date", "name", *more)).alias("m"))
    return best.select("feed", "m.name", "m.drop_date", *(f"m.{c}" for c in more))


def require_feeds(
    drops: DataFrame | list, feeds: tuple[str, ...] = tuple(FEED_PREFIXES)
) -> dict[str, tuple[str, object]]:
    """The per-feed choice (at most one row per feed, collected here if it isn't yet); fails when a
    feed has no file, naming it."""
    rows = drops.collect() if isinstance(drops, DataFrame) else drops
    found = {r["feed"]: (r["name"], r["drop_date"]) for r in rows}
    missing = [f for f in feeds if f not in found]
    if missing:
        raise MissingFeedError(f"no drop file for feed(s): {', '.join(missing)}")
    return found


def unseen_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that are not in the ledger of ingested files (``left_anti``).

    A file is known by its name, length and modification time (those that both
    frames have), so a corrected file sent again under the same name is new.

    Replaces moving files to an archive folder: consumption is recorded with the
    load's publish record, so a crash never loses or repeats a file.
    """
    on = [c for c in FILE_KEY if c in files.columns and c in ledger.columns]
    return files.join(ledger.select(*on), on, "left_anti")
