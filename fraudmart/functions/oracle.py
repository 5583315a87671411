"""Column expressions that keep the reference's Oracle semantics in Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudmart.schemas import AMT


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(last: str | Column, first: str | Column, patronymic: str | Column) -> Column:
    """Oracle ``last || ' ' || first || ' ' || patronymic`` (F2, H2).

    Oracle's ``||`` treats NULL as empty, so a missing patronymic gives
    ``'Last First '`` with the trailing space.  Spark's ``||`` would give NULL and
    ``concat_ws`` would drop the separator, so coalesce each part.
    """
    return F.concat(
        F.coalesce(_col(last), F.lit("")),
        F.lit(" "),
        F.coalesce(_col(first), F.lit("")),
        F.lit(" "),
        F.coalesce(_col(patronymic), F.lit("")),
    )


def empty_as_null(c: str | Column) -> Column:
    """Oracle stores an empty ``varchar2`` as NULL (H3)."""
    return F.nullif(_col(c), F.lit(""))


def change_time(update_dt: str | Column = "update_dt", create_dt: str | Column = "create_dt") -> Column:
    """Time of the last change of a source row: ``COALESCE(update_dt, create_dt)`` (F1)."""
    return F.coalesce(_col(update_dt), _col(create_dt))


def parse_oracle_timestamp(c: str | Column) -> Column:
    """``to_date(s, 'YYYY-MM-DD HH24:MI:SS')`` keeping the time."""
    return F.to_timestamp_ntz(_col(c), F.lit("yyyy-MM-dd HH:mm:ss"))


def parse_amount(c: str | Column) -> Column:
    """Amount text to ``decimal(18,2)``, accepting a decimal comma (H9).

    Read as text first: the CSV reader with a decimal schema silently turns
    ``2,45`` into ``245.00``.  The cast rounds half up.
    """
    text = F.regexp_replace(F.trim(_col(c)), ",", ".")
    return F.nullif(text, F.lit("")).cast(AMT)


def check_max_length(c: str | Column, limit: int, what: str) -> Column:
    """Fail the job when a value exceeds a ``varchar2(limit)`` target (H4)."""
    col = _col(c)
    return F.when(
        F.length(col) > F.lit(limit),
        F.raise_error(F.concat(F.lit(f"{what} longer than {limit} characters: "), col)),
    ).otherwise(col)


def enforce_varchar(df, limit: int, columns: list[str] | None = None):
    """Fail the load when a text value exceeds ``varchar2(limit)``, as the target
    table would reject the insert (1.2).  Length counts characters."""
    from pyspark.sql import types as T

    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(
        *[check_max_length(c, limit, c).alias(c) if c in names else F.col(c) for c in df.columns]
    )
