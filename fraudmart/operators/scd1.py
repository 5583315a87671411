"""SCD type 1 maintenance of dimensions.

Parquet tables take neither MERGE nor DELETE, so both are expressed as joins that
produce the next full version of the dimension:

* upsert = target FULL OUTER JOIN staging on the key, each row from staging where it
  has one, so every target row of a staged key is updated, also if the key is there twice;
* delete = target rows whose key is still in the source (``left_semi``).

NULL keys follow SQL equality: a NULL key never matches, so a NULL-key staging row
is inserted every time (H16) and a NULL-key target row is never deleted (H17).
NULL-key rows are routed *around* the join: in a hash shuffle all NULLs land in
one partition, and NULL keys can be a large share of a dirty table.  The
``IS NULL`` scan is a pushed filter that row-group statistics mostly skip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """MERGE cannot update one target row from two staging rows."""


def duplicate_keys(staging: DataFrame, key: str) -> DataFrame:
    """Non-NULL keys that occur more than once in staging (partial aggregate)."""
    return (
        staging.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def assert_unique_keys(staging: DataFrame, key: str, sample: int = 5) -> None:
    """Raise when staging holds a key twice; NULL keys are exempt.

    Only a bounded sample of offending keys reaches the driver.
    """
    dups = duplicate_keys(staging, key).limit(sample).collect()
    if dups:
        shown = ", ".join(f"{r[key]!r} x{r['n']}" for r in dups)
        raise DuplicateKeyError(f"staging has duplicate {key}: {shown}")


def _split_null_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())


def _merge(target: DataFrame, staging: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Rows with non-NULL keys: matched and new ones from ``staging`` (unique keys), the others as they are."""
    news = staging.select(*[F.col(c).alias(f"_new_{c}") for c in cols])
    joined = target.select(*cols).join(news, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    staged = F.col(f"_new_{key}").isNotNull()
    return joined.select(*[F.when(staged, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in cols])


def scd1_upsert(target: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """MERGE: matched target rows take every staged column, unmatched staged rows insert.

    The result keeps the target's column order.
    """
    cols = target.columns
    keyed, null_keyed = _split_null_keys(target, key)
    staged, null_staged = _split_null_keys(staging.select(*cols), key)
    return _merge(keyed, staged, key, cols).unionByName(null_keyed).unionByName(null_staged)


def vanished_keys(target: DataFrame, staging: DataFrame, source_keys: DataFrame, key: str, source_key: str = "id") -> DataFrame:
    """Non-NULL keys of the target or of staging that the source no longer has.

    Only key columns are read and shuffled.
    """
    known = target.select(key).unionByName(staging.select(key)).where(F.col(key).isNotNull())
    src = source_keys.select(F.col(source_key).alias(key)).where(F.col(key).isNotNull())
    return known.join(src, key, "left_anti").distinct()


def _merge_small(target: DataFrame, staging: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """:func:`_merge` for a staging side that is small enough to broadcast (checked by the caller).

    The target is read twice, its keys alone the second time, and never shuffled; what is
    aggregated are staged keys that it has.
    """
    news = F.broadcast(staging.select(F.col(key).alias("_key"), F.struct(*cols).alias("_new")))
    row = F.coalesce(F.col("_new"), F.struct(*cols))
    updated = target.join(news, F.col(key) == F.col("_key"), "left").select(row.alias("_row")).select("_row.*")
    had = target.select(key).join(F.broadcast(staging.select(key)), key, "left_semi").distinct()
    return updated.unionByName(staging.select(*cols).join(F.broadcast(had), key, "left_anti"))


def scd1_apply_vanished(target: DataFrame, staging: DataFrame, vanished: DataFrame, key: str, small: bool = False) -> DataFrame:
    """:func:`scd1_apply` with the vanished keys known: ``target`` may then be any set of whole key parts.

    ``small`` says that staging and the vanished keys were measured and fit a broadcast; then the
    target isn't shuffled.
    """
    cols = target.columns
    keyed, null_target = _split_null_keys(target, key)
    staged, null_staged = _split_null_keys(staging.select(*cols), key)
    gone = F.broadcast(vanished) if small else vanished
    merge = _merge_small if small else _merge
    merged = merge(keyed.join(gone, key, "left_anti"), staged.join(gone, key, "left_anti"), key, cols)
    return merged.unionByName(null_target.select(*cols)).unionByName(null_staged)


def key_counts(target: DataFrame, staging: DataFrame, source_keys: DataFrame, key: str, source_key: str = "id") -> DataFrame:
    """Per non-NULL key of the target or of staging: ``n_target`` and ``n_staged`` rows, and whether the source lacks it (``gone``).

    Only key columns are read and shuffled, each once; that tells vanished keys, staged keys that are there
    twice (H15) and which rows of the target a MERGE leaves as they are.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = target.select(key, one.alias("_t"), none.alias("_s")).unionByName(staging.select(key, none.alias("_t"), one.alias("_s")))
    known = sides.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("_t").alias("n_target"), F.sum("_s").alias("n_staged"))
    src = source_keys.select(F.col(source_key).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    return known.join(src, F.col(key) == F.col("_id"), "left").select(key, "n_target", "n_staged", F.col("_id").isNull().alias("gone"))


def key_marks(counts: DataFrame, key: str, mostly: bool) -> DataFrame:
    """The keys of :func:`key_counts` that :func:`scd1_apply_marked` must know: those that vanished, and

    * ``mostly``, where staging has most of the target: the target's keys that aren't staged, and staged keys that
      the target has more than once;
    * else: staged keys that the target has.
    """
    had, staged = F.col("n_target") > 0, F.col("n_staged") > 0
    more = (had & ~staged) | (staged & (F.col("n_target") > 1)) if mostly else had & staged
    return counts.where(F.col("gone") | more).select(key, "n_target", staged.alias("staged"), "gone")


def scd1_apply_marked(target: DataFrame, staging: DataFrame, marks: DataFrame, key: str, mostly: bool) -> DataFrame:
    """:func:`scd1_apply` for marks of :func:`key_marks` that are small enough to broadcast (checked by the caller).

    A row of the target stays as it is or a staged row takes its place, once for each row of its key, so
    keys tell all and neither side's rows are shuffled.  ``target`` may be any set of whole key parts.
    """
    cols = target.columns
    keyed, null_target = _split_null_keys(target, key)
    staged, null_staged = _split_null_keys(staging.select(*cols), key)
    if mostly:
        kept = keyed.join(F.broadcast(marks.where(~F.col("gone") & ~F.col("staged")).select(key)), key, "left_semi")
    else:
        kept = keyed.join(F.broadcast(marks.select(key)), key, "left_anti")
    other = marks.where(F.col("gone") | (F.col("staged") & (F.col("n_target") > 1)))
    news = staged.join(F.broadcast(other.select(F.col(key).alias("_key"), "gone", "n_target")), F.col(key) == F.col("_key"), "left")
    news = news.where(~F.coalesce("gone", F.lit(False)))
    copies = F.sequence(F.lit(1).cast("long"), F.greatest(F.coalesce("n_target", F.lit(1)), F.lit(1)))
    placed = news.select(*cols, F.explode(copies).alias("_copy")).select(*cols)
    return kept.select(*cols).unionByName(placed).unionByName(null_target.select(*cols)).unionByName(null_staged)


def missing_keys(target: DataFrame, source_keys: DataFrame, key: str, source_key: str = "id") -> DataFrame:
    """Target keys with no source row (``LEFT JOIN ... WHERE s.id IS NULL``).

    NULL target keys are included, as in the reference's list; they are still
    never deleted, because ``NULL IN (...)`` is not true.  They match nothing, so they
    go around the join instead of meeting in one of its partitions.
    """
    src = source_keys.select(F.col(source_key).alias(key)).where(F.col(key).isNotNull())
    keyed, null_keyed = _split_null_keys(target.select(key), key)
    return keyed.join(src, key, "left_anti").unionByName(null_keyed)


def scd1_delete(target: DataFrame, source_keys: DataFrame, key: str, source_key: str = "id") -> DataFrame:
    """DELETE rows whose key left the source; NULL-key rows stay.

    An empty source deletes every non-NULL-key row (H18), as the reference does.
    ``left_semi`` never multiplies target rows, even with duplicate source keys.
    """
    cols = target.columns
    keyed, null_keyed = _split_null_keys(target, key)
    src = source_keys.select(F.col(source_key).alias(key)).where(F.col(key).isNotNull())
    return keyed.join(src, key, "left_semi").select(*cols).unionByName(null_keyed.select(*cols))


def scd1_apply(
    target: DataFrame, staging: DataFrame, source_keys: DataFrame, key: str, source_key: str = "id"
) -> DataFrame:
    """Upsert then delete in one plan: ``scd1_delete(scd1_upsert(t, s), keys)``.

    Composing the two primitives would split the upsert's output into NULL and
    non-NULL keys again.  Here every input is split once; the current dimension and
    the staged rows meet the (reused) source-key exchange by semi joins and then
    each other, all on the same key, so the dimension is hash-partitioned once.
    NULL-key rows of both sides bypass the joins (H16, H17).
    """
    cols = target.columns
    keyed, null_target = _split_null_keys(target, key)
    staged, null_staged = _split_null_keys(staging.select(*cols), key)
    src = source_keys.select(F.col(source_key).alias(key)).where(F.col(key).isNotNull())
    merged = _merge(keyed.join(src, key, "left_semi"), staged.join(src, key, "left_semi"), key, cols)
    return merged.unionByName(null_target.select(*cols)).unionByName(null_staged)
