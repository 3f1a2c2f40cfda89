"""Type 2 dimensions: version history, incremental application, unknown member.

History needs the row before and the row after within a key. A plain window over
the key would put a hot key into one task, so rows are dealt by ranges of key and start
(:mod:`.segments`) and windowed inside a segment, and one summary row per key and segment carries the
state over the borders. A key that fits a segment has one summary row, a hot key one for each
segment that its rows fill, however they lie in time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contract import Scd2
from ..functions.keys import surrogate_key
from .dedup import deduplicate_by_latest
from .segments import SEGMENT, in_segments

# Start of validity where the source has no change timestamp.
ORIGIN = "1900-01-01 00:00:00"

_NOW = "_now"


def _change_points(df: DataFrame, keys: Sequence[str], ts: str, track: Sequence[str]) -> DataFrame:
    """Rows at which a tracked column differs from the row before, with ``_version`` and ``_next``."""
    rows = in_segments(df, keys, [ts]).withColumn(_NOW, F.struct(*track))
    group = [*keys, SEGMENT]
    in_segment = Window.partitionBy(*group).orderBy(ts)
    marked = (
        rows.withColumn("_before", F.lag(_NOW).over(in_segment))
        .withColumn("_first", F.col("_before").isNull())
        .withColumn("_changed", ~F.col("_first") & ~F.col("_before").eqNullSafe(F.col(_NOW)))
    )
    summary = marked.groupBy(*group).agg(
        F.min_by(_NOW, ts).alias("_opening"),
        F.max_by(_NOW, ts).alias("_closing"),
        F.min(ts).alias("_start"),
        F.min(F.when(F.col("_changed"), F.col(ts))).alias("_inner_start"),
        F.sum(F.col("_changed").cast("long")).alias("_inner_changes"),
    )
    forward = Window.partitionBy(*keys).orderBy(SEGMENT)
    earlier = forward.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc(SEGMENT)).rowsBetween(Window.unboundedPreceding, -1)
    last_state = F.lag("_closing").over(forward)
    carried = (
        summary.withColumn("_opens", last_state.isNull() | ~last_state.eqNullSafe(F.col("_opening")))
        .withColumn("_changes", F.col("_inner_changes") + F.col("_opens").cast("long"))
        .withColumn("_first_change", F.when(F.col("_opens"), F.col("_start")).otherwise(F.col("_inner_start")))
        .withColumn("_offset", F.coalesce(F.sum("_changes").over(earlier), F.lit(0)))
        .withColumn("_next_change", F.last("_first_change", ignorenulls=True).over(later))
        .select(*group, "_opens", "_offset", "_next_change")
    )
    # NULL-safe on the keys would cost the sort-merge plan; business keys are required.
    points = marked.join(carried, group).filter(
        F.col("_changed") | (F.col("_first") & F.col("_opens"))
    )
    return (
        points.withColumn("_version", F.col("_offset") + F.row_number().over(in_segment))
        .withColumn("_next", F.coalesce(F.lead(ts).over(in_segment), F.col("_next_change")))
        .drop(SEGMENT, _NOW, "_before", "_first", "_changed", "_opens", "_offset", "_next_change")
    )


def _finish(points: DataFrame, keys: Sequence[str], spec: Scd2, attributes: Sequence[str], start: str) -> DataFrame:
    """Name the mechanics columns of a dimension."""
    columns = [
        surrogate_key([F.col(k) for k in keys], F.col(start)).alias(spec.surrogate_key),
        *[F.col(a) for a in attributes],
        F.col(start).alias(spec.effective_from),
        F.col("_next").alias(spec.effective_to),
        F.col("_next").isNull().alias(spec.current_flag),
    ]
    if spec.version:
        columns.append(F.col("_version").cast("long").alias(spec.version))
    if spec.change_reason:
        reason = F.when(F.col("_version") == 1, F.lit("initial")).otherwise(F.lit("attribute_change"))
        columns.append(reason.alias(spec.change_reason))
    return points.select(*columns)


def _prepared(df: DataFrame, keys: Sequence[str], spec: Scd2, as_of_origin: str) -> tuple[DataFrame, str, list[str]]:
    """Rows with a filled business key and start, one per key and start."""
    attributes = list(df.columns)
    start = "_valid_from"
    origin = F.lit(as_of_origin).cast("timestamp")
    moment = F.coalesce(F.col(spec.timestamp), origin) if spec.timestamp else origin
    filled = df.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys)).withColumn(start, moment)
    # Two rows of a key at one instant cannot both be in force.
    return deduplicate_by_latest(filled, [*keys, start], start), start, attributes


def scd2_history(df: DataFrame, keys: Sequence[str], spec: Scd2, *, origin: str = ORIGIN) -> DataFrame:
    """All versions from the full change history of a source.

    A version starts at a row that differs in a tracked column from the row before,
    keeps the attributes of that row, and ends where the next version starts.
    """
    rows, start, attributes = _prepared(df, keys, spec, origin)
    points = _change_points(rows, keys, start, spec.track)
    return with_unknown_member(_finish(points, keys, spec, attributes, start), spec)


def scd2_apply(dim: DataFrame, incoming: DataFrame, keys: Sequence[str], spec: Scd2, *,
               origin: str = ORIGIN) -> DataFrame:
    """The dimension after a further batch of source rows.

    Closed versions stay as they are, and so do keys without incoming rows. Open
    versions and the newer incoming rows of the same keys form a short history that is
    cut anew; a key without change keeps its open version, surrogate key included, so
    that a re-run changes nothing. Incoming rows that are not newer than the open
    version are ignored. ``dim`` is read several times, so it should be a stored table.
    """
    known = dim if spec.unknown_member is None else dim.filter(F.col(spec.surrogate_key) != spec.unknown_member)
    rows, start, attributes = _prepared(incoming, keys, spec, origin)
    new = [a for a in attributes if a not in known.columns]  # columns the dimension did not have yet
    known = known.withColumns({a: F.lit(None).cast(incoming.schema[a].dataType) for a in new})
    # Only open versions of incoming keys are cut anew. All other rows pass through a join
    # with the distinct incoming keys, which for a small batch shuffles nothing.
    batch = rows.select(*keys).distinct()
    opened = known.filter(spec.current_flag).join(batch, list(keys), "left_semi")
    passing = known.join(batch.withColumn("_hit", F.lit(True)), list(keys), "left").filter(
        ~F.col(spec.current_flag) | F.col("_hit").isNull()
    )
    base = F.col(spec.version) - 1 if spec.version else F.lit(0)
    bounds = opened.select(*keys, F.col(spec.effective_from).alias("_open_from"), base.alias("_base"))
    newer = rows.join(bounds, list(keys), "left").filter(
        F.col("_open_from").isNull() | (F.col(start) > F.col("_open_from"))
    )
    if not spec.timestamp:
        # Without a change timestamp a changed row cannot be dated; the sentinel serves new keys only.
        newer = newer.filter(F.col("_open_from").isNull())
    seeds = opened.select(*attributes, F.col(spec.effective_from).alias(start), base.alias("_base"))
    history = newer.select(*attributes, start, F.coalesce("_base", F.lit(0)).alias("_base")).unionByName(seeds)
    points = _change_points(history, keys, start, spec.track)
    rebuilt = _finish(points.withColumn("_version", F.col("_version") + F.col("_base")), keys, spec, attributes, start)
    return with_unknown_member(passing.select(*rebuilt.columns).unionByName(rebuilt), spec)


def scd2_snapshot_apply(dim: DataFrame, snapshot: DataFrame, keys: Sequence[str], spec: Scd2, as_of: str) -> DataFrame:
    """Apply an undated snapshot: changed keys get a version that starts at ``as_of``."""
    dated = snapshot.withColumn("_as_of", F.lit(as_of).cast("timestamp"))
    known = dim.filter(F.col(spec.current_flag)).select(*keys, F.lit(True).alias("_known"))
    sentinel = F.lit(ORIGIN).cast("timestamp")
    rows = dated.join(known, list(keys), "left").withColumn(
        "_as_of", F.when(F.col("_known"), F.col("_as_of")).otherwise(sentinel)
    ).drop("_known")
    timed = Scd2(**{**spec.__dict__, "timestamp": "_as_of"})
    return scd2_apply(dim, rows, keys, timed).drop("_as_of")


def late_rows(dim: DataFrame, incoming: DataFrame, keys: Sequence[str], spec: Scd2) -> DataFrame:
    """Incoming rows that :func:`scd2_apply` ignores although a tracked column differs."""
    opened = dim.filter(F.col(spec.current_flag)).select(
        *keys, F.col(spec.effective_from).alias("_open_from"), F.struct(*spec.track).alias("_open")
    )
    return (
        incoming.join(opened, list(keys))
        .filter(F.col(spec.timestamp) <= F.col("_open_from"))
        .filter(~F.struct(*spec.track).eqNullSafe(F.col("_open")))
        .drop("_open_from", "_open")
    )


def with_unknown_member(dim: DataFrame, spec: Scd2) -> DataFrame:
    """Add the row that facts without a known member refer to."""
    if spec.unknown_member is None:
        return dim
    values = {
        spec.surrogate_key: F.lit(spec.unknown_member),
        spec.effective_from: F.lit(ORIGIN).cast("timestamp"),
        spec.current_flag: F.lit(True),
    }
    if spec.version:
        values[spec.version] = F.lit(1)
    row = dim.sparkSession.range(1).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(row)
