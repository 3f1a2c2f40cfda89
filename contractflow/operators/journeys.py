"""What users do in order: sessions, funnels, requests and their completion. A hot user is spread over segments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import SEGMENT, in_segments, last_before


def sessions(events: DataFrame, user: str, timestamp: str, tiebreak: str, gap: str) -> DataFrame:
    """Events of a user with no pause longer than ``gap`` (an interval text) between neighbours, stitched to sessions.

    A row a session: user, ``session`` (from 1), ``started``, ``ended``, ``n_events``. Events without a user or time are left out. Within a
    segment a window finds the pauses; the last event before a segment decides about its first one, and the sessions begun in earlier
    segments are added to the number.
    """
    known = events.where(F.col(user).isNotNull() & F.col(timestamp).isNotNull()).select(
        F.col(user).alias("_user"), F.col(timestamp).cast("timestamp").alias("_at"), F.col(tiebreak).alias("_tie"))
    known = known.withColumn("_event", F.col("_at"))
    rows = in_segments(known, ["_user"], ["_at", "_tie"])
    inside = Window.partitionBy(SEGMENT, "_user").orderBy("_at", "_tie")
    before = last_before(rows, ["_user"], ["_at", "_tie"], "_event")
    earlier = F.coalesce(F.lag("_at").over(inside), F.when(F.col("_carried._user") == F.col("_user"), F.col("_carried._event")))
    marked = rows.join(before, SEGMENT, "left").withColumn("_earlier", earlier)
    begins = F.col("_earlier").isNull() | (F.col("_at") > F.col("_earlier") + F.expr(f"INTERVAL {gap}"))
    marked = marked.withColumn("_begins", begins.cast("long")).withColumn("_number", F.sum("_begins").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)))
    # A session is first summed up within each segment, so a hot user gives one row a session and segment.
    pieces = marked.groupBy("_user", SEGMENT, "_number").agg(
        F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.count("*").alias("_n"))
    begun = marked.groupBy("_user", SEGMENT).agg(F.sum("_begins").alias("_begun"))
    so_far = Window.partitionBy("_user").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = begun.select("_user", SEGMENT, F.coalesce(F.sum("_begun").over(so_far), F.lit(0)).alias("_offset"))
    numbered = pieces.join(offsets, ["_user", SEGMENT]).withColumn("session", F.col("_offset") + F.col("_number"))
    return numbered.groupBy(F.col("_user").alias(user), "session").agg(
        F.min("_from").alias("started"), F.max("_to").alias("ended"), F.sum("_n").alias("n_events"))


def funnel(events: DataFrame, user: str, timestamp: str, tiebreak: str, kind: str, steps: Sequence[str]) -> DataFrame:
    """How far each user went through ``steps`` in order: a row a user that took the first, with ``at_1``, ``at_2``... and ``reached``.

    A step counts from the first event of its kind after the step before it. The state of a user is the moment of the last step
    taken, so each step is one aggregate over the events of its kind: however many a user has, a task sends one row on.
    """
    moment = F.struct(F.col(timestamp).alias("at"), F.col(tiebreak).alias("tie"))
    known = events.where(F.col(user).isNotNull() & F.col(timestamp).isNotNull())

    def of(step: str) -> DataFrame:
        return known.where(F.col(kind) == step).select(user, moment.alias("_now"))

    state = of(steps[0]).groupBy(user).agg(F.min("_now").alias("_last")).withColumn("at_1", F.col("_last.at"))
    for i, step in enumerate(steps[1:], start=2):
        later = of(step).join(state.select(user, F.col("_last").alias("_before")), user).where(F.col("_now") > F.col("_before"))
        taken = later.groupBy(user).agg(F.min("_now").alias("_next"))
        state = state.join(taken, user, "left").withColumn(f"at_{i}", F.col("_next.at")).withColumn("_last", F.col("_next")).drop("_next")
    names = [f"at_{i + 1}" for i in range(len(steps))]
    reached = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in names])
    return state.select(user, *names, reached.alias("reached"))


def completions(events: DataFrame, user: str, timestamp: str, tiebreak: str, kind: str, request: str, completion: str) -> DataFrame:
    """Requests with the completion that answers them, one to one: a completion answers the nearest request before it, and a
    request is answered by the first completion after it, if no other request lies between.

    A row a request: user, tiebreak, ``requested``, ``completed`` and ``latency_micros`` (NULL if unanswered).
    """
    known = events.where(F.col(user).isNotNull() & F.col(timestamp).isNotNull() & F.col(kind).isin(request, completion))
    rows = in_segments(known.select(
        F.col(user).alias("_user"), F.col(timestamp).cast("timestamp").alias("_at"), F.col(tiebreak).alias("_tie"),
        (F.col(kind) == request).alias("_asks")), ["_user"], ["_at", "_tie"])
    event = F.struct(F.col("_at").alias("at"), F.col("_asks").alias("asks"))
    rows = rows.withColumn("_event", event)
    inside = Window.partitionBy(SEGMENT, "_user").orderBy("_at", "_tie")
    # Over a border the next event is that of the segment after, so segments are carried in falling order.
    place = F.struct("_user", "_at", "_tie")
    own = rows.groupBy(SEGMENT).agg(F.min_by(F.struct("_user", "_event"), place).alias("_own"))
    after = own.select(SEGMENT, F.lead("_own").over(Window.orderBy(SEGMENT)).alias("_next"))
    following = F.coalesce(F.lead("_event").over(inside), F.when(F.col("_next._user") == F.col("_user"), F.col("_next._event")))
    found = rows.join(after, SEGMENT, "left").withColumn("_following", following).where("_asks")
    done = F.when(~F.col("_following.asks"), F.col("_following.at"))
    return found.select(
        F.col("_user").alias(user), F.col("_tie").alias(tiebreak), F.col("_at").alias("requested"), done.alias("completed"),
        (F.unix_micros(done) - F.unix_micros("_at")).alias("latency_micros"))


#: Bits of a number that tell buckets of a sketch apart: a quantile is at most one part in 2**SKETCH_BITS too large.
SKETCH_BITS = 5


def sketch_bucket(x: Column) -> Column:
    """Upper bound of the bucket of a number that is not negative: its first ``SKETCH_BITS + 1`` binary digits, the rest ones."""
    shift = F.greatest(F.length(F.bin(x)) - (SKETCH_BITS + 1), F.lit(0))
    unit = F.expr("1L").cast("long") * F.pow(F.lit(2.0), shift).cast("long")
    return F.floor(x / unit).cast("long") * unit + unit - 1


def quantile_sketch(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """A mergeable sketch: counts by bucket. Sketches of parts add up to that of the whole; buckets are few, as they grow with the number."""
    return df.where(F.col(value).isNotNull()).groupBy(*groups, sketch_bucket(F.col(value)).alias("bucket")).agg(F.count("*").alias("n"))


def sketch_quantiles(sketch: DataFrame, groups: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """Quantiles by group from a sketch, each the bound of the bucket that holds the value of its rank: never below the exact one,
    and above it by at most one part in ``2**SKETCH_BITS``."""
    order = Window.partitionBy(*groups).orderBy("bucket")
    ranked = sketch.withColumn("_upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "_all", F.sum("n").over(Window.partitionBy(*groups)))
    columns = [F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * q), F.col("bucket"))).alias(f"q{round(q * 100)}") for q in quantiles]
    return ranked.groupBy(*groups).agg(F.max("_all").alias("n"), *columns)
