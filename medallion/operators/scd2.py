"""Type-2 slowly changing dimension: turn a batch of source rows into dim rows.

A source row is matched with a *current* dimension row of the same id that is
older (``dim.version < source.version``). Then:

* every source row becomes an open version (``current``, valid from its own
  version time to ``OPEN_END``): once per matched dim row, or once if none
  matched (new ids, unchanged rows, late rows, NULL id or version);
* every matched dim row is closed: it keeps its key, attributes and
  ``valid_from``, and takes the version time of the source row as
  ``datetime_updated`` and ``valid_to``.

``scd2_changes`` produces all of it from ONE left join; ``scd2_net_new``,
``scd2_new_versions`` and ``scd2_closures`` are the three parts as separate
joins (anti, inner, inner), whose union is the same bag of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.columns import open_end
from medallion.operators.sizing import small_side

CUSTOMER_ATTRS = ("first_name", "last_name", "state_id", "datetime_created")


def current_rows(dim: DataFrame, flag: str = "current") -> DataFrame:
    """Rows whose flag is true (NULL counts as not current)."""
    return dim.where(F.col(flag))


def _dim_side(dim: DataFrame, id_col: str, key_col: str, attrs: Sequence[str], version_col: str) -> DataFrame:
    return current_rows(dim).select(
        F.col(id_col).alias("_d_id"),
        F.col(key_col).alias("_d_key"),
        *[F.col(a).alias(f"_d_{a}") for a in attrs],
        F.col(version_col).alias("_d_version"),
        F.col("valid_from").alias("_d_valid_from"),
    )


def _match(id_col: str, version_col: str) -> Column:
    return (F.col(id_col) == F.col("_d_id")) & (F.col("_d_version") < F.col(version_col))


def _opened(base: Sequence[str], version_col: str) -> list[Column]:
    return [
        *[F.col(c).alias(c) for c in base],
        F.lit(True).alias("current"),
        F.col(version_col).alias("valid_from"),
        open_end().alias("valid_to"),
    ]


def _closed(id_col: str, key_col: str, attrs: Sequence[str], version_col: str) -> list[Column]:
    return [
        F.col("_d_id").alias(id_col),
        F.col("_d_key").alias(key_col),
        *[F.col(f"_d_{a}").alias(a) for a in attrs],
        F.col(version_col).alias(version_col),
        F.lit(False).alias("current"),
        F.col("_d_valid_from").alias("valid_from"),
        F.col(version_col).alias("valid_to"),
    ]


def scd2_changes(
    source: DataFrame,
    dim: DataFrame,
    *,
    id_col: str = "id",
    key_col: str = "customer_sur_id",
    version_col: str = "datetime_updated",
    attrs: Sequence[str] = CUSTOMER_ATTRS,
    broadcast_ids: bool | None = None,
) -> DataFrame:
    """Open and closing versions for one source batch, from one join.

    ``source`` must carry ``key_col`` already (see ``with_surrogate_key``) and
    should be a scan or a staged table: it is read more than once.
    A *late* row is older than the current version of its id; it opens a
    version like any unmatched row (a second current row for the id, as the
    original job does).

    The dimension is reduced to the batch's ids before the join. Their size is
    checked (``broadcast_ids=None`` measures it): ids that fit are broadcast,
    so a batch costs one pass over the current rows and no shuffle of them;
    more ids than that meet the dimension by shuffle.
    Rows with a NULL id or version can never match; they skip the join (and
    its shuffle) entirely, so a batch full of them cannot pile into the one
    shuffle partition NULL keys hash to. Hot non-NULL ids are split by AQE's
    skew-join handling.
    """
    base = [id_col, key_col, *attrs, version_col]
    src = source.select(*base)
    joinable = src.where(F.col(id_col).isNotNull() & F.col(version_col).isNotNull())
    unmatchable = src.where(F.col(id_col).isNull() | F.col(version_col).isNull())

    ids = small_side(joinable.select(F.col(id_col).alias("_b_id")), broadcast_ids)
    side = _dim_side(dim, id_col, key_col, attrs, version_col)
    side = side.join(ids, F.col("_d_id") == F.col("_b_id"), "left_semi")
    joined = joinable.join(side, _match(id_col, version_col), "left")
    open_row = F.struct(*_opened(base, version_col))
    close_row = F.struct(*_closed(id_col, key_col, attrs, version_col))
    rows = F.when(F.col("_d_id").isNotNull(), F.array(open_row, close_row)).otherwise(
        F.array(open_row)
    )
    changes = joined.select(F.explode(rows).alias("_row")).select("_row.*")
    return changes.unionByName(unmatchable.select(*_opened(base, version_col)))


def scd2_net_new(
    source: DataFrame,
    dim: DataFrame,
    *,
    id_col: str = "id",
    key_col: str = "customer_sur_id",
    version_col: str = "datetime_updated",
    attrs: Sequence[str] = CUSTOMER_ATTRS,
) -> DataFrame:
    """Source rows with no older current dim row (left anti join)."""
    base = [id_col, key_col, *attrs, version_col]
    return source.select(*base).join(
        _dim_side(dim, id_col, key_col, attrs, version_col), _match(id_col, version_col), "left_anti"
    ).select(*_opened(base, version_col))


def scd2_new_versions(
    source: DataFrame,
    dim: DataFrame,
    *,
    id_col: str = "id",
    key_col: str = "customer_sur_id",
    version_col: str = "datetime_updated",
    attrs: Sequence[str] = CUSTOMER_ATTRS,
) -> DataFrame:
    """Source rows that replace an older current dim row (inner join)."""
    base = [id_col, key_col, *attrs, version_col]
    return source.select(*base).join(
        _dim_side(dim, id_col, key_col, attrs, version_col), _match(id_col, version_col)
    ).select(*_opened(base, version_col))


def scd2_closures(
    source: DataFrame,
    dim: DataFrame,
    *,
    id_col: str = "id",
    key_col: str = "customer_sur_id",
    version_col: str = "datetime_updated",
    attrs: Sequence[str] = CUSTOMER_ATTRS,
) -> DataFrame:
    """Current dim rows replaced by a newer source row, closed (inner join)."""
    return _dim_side(dim, id_col, key_col, attrs, version_col).join(
        source.select(id_col, version_col), _match(id_col, version_col)
    ).select(*_closed(id_col, key_col, attrs, version_col))


def scd2_changes_three_joins(source: DataFrame, dim: DataFrame, **kw) -> DataFrame:
    """The same rows as ``scd2_changes``, as the union of the three parts."""
    return (
        scd2_net_new(source, dim, **kw)
        .unionByName(scd2_new_versions(source, dim, **kw))
        .unionByName(scd2_closures(source, dim, **kw))
    )
