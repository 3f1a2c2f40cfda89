"""Run one contract: read, shape, enforce, check, deduplicate, split, mask, stamp, write."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterable, Mapping
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract
from ..operators import dedup, privacy, quality, schema, scd2, service_levels
from ..operators.merge import reprocess_slice
from ..session import apply_settings, scratch_path
from ..sinks.claims import LEASE, WRITER
from ..sinks.runlog import append_run, attempts, new_run_id
from ..sinks.tables import Tables
from ..sources.documents import extract_fields, read_documents
from ..sources.landing import SOURCE_FILE, SOURCE_MTIME, landed_rows, no_rows, read_landing, read_window, stream_landing

STAMP_SOURCE = "_source"
STAMP_TIME = "_processed_at"
STAMP_RUN = "_run_id"
STAMP_CONTRACT = "_contract_name"
STAMPS = (STAMP_SOURCE, STAMP_TIME, STAMP_RUN, STAMP_CONTRACT)
_HELPERS = (SOURCE_FILE, SOURCE_MTIME)


@dataclass
class RunResult:
    contract: str
    layer: str
    status: str
    good: int = 0
    quarantined: int = 0
    report: dict = field(default_factory=dict)
    refused: bool = False  # nothing but quarantine was stored


def stamp(df: DataFrame, contract: Contract, run_id: str, now: Column, *, source: Column | None = None,
          domain: bool = False) -> DataFrame:
    """Lineage columns: where a row came from, when, in which run and by which contract."""
    columns = {
        STAMP_SOURCE: source if source is not None else F.lit(contract.source.path or contract.name),
        STAMP_TIME: now.cast("timestamp"),
        STAMP_RUN: F.lit(run_id),
        STAMP_CONTRACT: F.lit(contract.name),
    }
    if domain:
        columns["_domain"] = F.lit(contract.domain)
    return df.withColumns(columns)


def shape(contract: Contract, inputs: Mapping[str, DataFrame], salt: str = "") -> DataFrame:
    """The contract's transform over ``source`` and its links, else the source itself.

    A transform that compares hashed columns says so by an attribute ``takes_salt`` and is given the salt.
    """
    if contract.transform is None:
        df = inputs["source"]
    elif getattr(contract.transform, "takes_salt", False):
        df = contract.transform(inputs, salt=salt)
    else:
        df = contract.transform(inputs)
    return df.drop(*contract.drop) if contract.drop else df


def compile_contract(contract: Contract, inputs: Mapping[str, DataFrame], *,
                     observation: Observation | None = None, cast_checks: bool = False, salt: str = "") -> DataFrame:
    """One lazy plan up to and including ``_errors``. Nothing is executed."""
    if observation is not None and not contract.transform:
        inputs = {**inputs, "source": inputs["source"].observe(observation, F.count(F.lit(1)).alias("rows"))}
    df = shape(contract, inputs, salt)
    declared = set(contract.field_names)
    df = df.drop(*[c for c in (*STAMPS, schema.UNCAST) if c not in declared])  # each layer sets its own
    carry = [c for c in _HELPERS if c in df.columns and c not in declared]
    conformed, checks = schema.conform(df, contract, carry, cast_checks=cast_checks)
    checks += [quality.rule_check(r) for r in contract.rules]
    if contract.dedup_before_rules:
        return quality.annotate(_deduplicated(conformed, contract), checks)
    # Bad rows all go to quarantine, so that a bad copy never displaces a good one.
    return _deduplicated(quality.annotate(conformed, checks), contract, keep=F.size(quality.ERRORS) > 0)


def _deduplicated(df: DataFrame, contract: Contract, keep: Column | None = None) -> DataFrame:
    if not contract.dedup_by:
        return df
    if contract.latest_by:
        return dedup.deduplicate_by_latest(df, contract.dedup_by, contract.latest_by, keep=keep)
    return dedup.deduplicate(df, contract.dedup_by, keep=keep)


def good_and_bad(contract: Contract, inputs: Mapping[str, DataFrame], salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Lazy good rows (masked, declared columns) and bad rows (masked, with errors)."""
    good, bad = quality.split(compile_contract(contract, inputs, salt=salt))
    drop = (schema.UNCAST, schema.UNKNOWN, *_HELPERS)
    return privacy.apply_masks(good.drop(*drop), contract, salt), privacy.apply_masks(bad, contract, salt)


def resolve_inputs(spark: SparkSession, contract: Contract, tables: Tables, landing_root: str | None = None,
                   window: tuple[datetime, datetime] | None = None) -> dict[str, DataFrame]:
    """The source and the links of a contract from stored tables or landing files.

    ``window`` limits landing files to the time folders between two moments. Without it an incremental source is not
    read here, see :func:`_take_new_files`.
    """
    source = contract.source
    inputs = _links(contract, tables)
    if source.format == "table":
        inputs["source"] = tables.read(source.path)
        return inputs
    path = f"{landing_root or tables.root}/{source.path}"
    if source.format == "text":
        inputs["source"] = extract_fields(read_documents(spark, path), contract)
    elif window:
        inputs["source"] = read_window(spark, contract, path, *window)
    else:
        inputs["source"] = read_landing(spark, contract, path)
    return inputs


def _links(contract: Contract, tables: Tables) -> dict[str, DataFrame]:
    return {name: tables.read(table) for name, table in contract.links.items()}


def is_incremental(contract: Contract) -> bool:
    return contract.source.format in ("csv", "json", "parquet") and contract.source.load_mode == "incremental"


def checkpoint_of(tables: Tables, contract: Contract) -> str:
    """Where it is kept which landing files a contract has taken."""
    return f"{tables.root}/_checkpoints/{contract.name}"


def _take_new_files(spark: SparkSession, contract: Contract, tables: Tables, landing_root: str | None, run_id: str | None,
                    dry_run: bool, **options) -> RunResult:
    """Run a contract on the landing files that it has not taken, as a file stream that ends when all are taken.

    A batch of files is a run, named by checkpoint and batch: after a break the same files come again under the same name.
    Files of a refused or failed run stay in their batch until a run takes them. A dry run works on a copy of the checkpoint.
    """
    path, state = f"{landing_root or tables.root}/{contract.source.path}", checkpoint_of(tables, contract)
    name = hashlib.sha256(state.encode()).hexdigest()[:16]
    if dry_run:
        state = _copied(spark, state, scratch_path(spark, "checkpoint"))
    results: list[RunResult] = []
    errors: list[Exception] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        own = Tables(session, tables.root)
        try:
            inputs = {"source": landed_rows(contract, batch), **_links(contract, own)}
            result = run_contract(session, contract, own, inputs, run_id=f"{name}-batch-{batch_id}", once=True, dry_run=dry_run,
                                  pipeline_run_id=run_id, **options)
        except Exception as error:
            errors.append(error)
            raise
        results.append(result)
        if result.refused:
            raise RuntimeError("refused")

    with tables.claims.held(f"{contract.name}-landing", WRITER, wait=2 * LEASE):
        query = stream_landing(spark, contract, path).writeStream.option("checkpointLocation", state).foreachBatch(handle).trigger(
            availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception:
            if errors:
                raise errors[0] from None
            if not (results and results[-1].refused):
                raise
    if not results:  # nothing new: the run is logged all the same
        inputs = {"source": no_rows(spark, contract), **_links(contract, tables)}
        return run_contract(spark, contract, tables, inputs, run_id=run_id, dry_run=dry_run, **options)
    report: dict = {}
    for r in results:
        for k, v in r.report.items():
            report[k] = (report.get(k, True) and v) if isinstance(v, bool) else max(filter(None, (report.get(k), v)), default=None) if k == "mtime" else (
                report.get(k, 0) + v)
    failed = any(r.status == "failed" for r in results)
    return RunResult(contract.name, contract.layer, "failed" if failed else results[-1].status, sum(r.good for r in results),
                     sum(r.quarantined for r in results), report, results[-1].refused)


def _copied(spark: SparkSession, source: str, target: str) -> str:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    if a.getFileSystem(conf).exists(a):
        jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)
    return target


def materialize(contract: Contract, tables: Tables, good: DataFrame, now: datetime | None = None) -> None:
    """Write good rows by the strategy of the contract; ``now`` is when a snapshot was taken."""
    if contract.strategy == "append":
        tables.append(contract.name, good, contract.partition_by)
    elif contract.strategy == "merge":
        if not contract.primary_key:
            raise ValueError(f"{contract.name}: merge needs a primary key")
        tables.merge(contract.name, good, contract.primary_key, contract.partition_by, contract.evolution)
    elif contract.strategy == "scd2":
        _materialize_scd2(contract, tables, good, now)
    elif contract.strategy == "overwrite":
        tables.replace(contract.name, good, contract.partition_by)
    else:
        raise ValueError(f"{contract.name}: unknown strategy {contract.strategy}")


BUCKET = "_bucket"


def _materialize_scd2(contract: Contract, tables: Tables, good: DataFrame, now: datetime | None) -> None:
    """Apply rows to a type 2 table. In a bucketed table only the buckets of the rows' keys are read and written; each has its
    open versions in a folder of their own, which is what a reader of the current state opens. The unknown member has a bucket to itself."""
    keys, spec, name = list(contract.primary_key), contract.scd2, contract.name
    bucket = F.pmod(F.xxhash64(*keys), F.lit(max(spec.buckets, 1))).cast("int")

    def stored(dim: DataFrame) -> tuple[DataFrame, list[str]]:
        if not spec.buckets:
            return dim, list(contract.partition_by)
        own = F.lit(False) if spec.unknown_member is None else F.col(spec.surrogate_key) == spec.unknown_member
        parts = [BUCKET, spec.current_flag]
        dim = dim.withColumn(BUCKET, F.when(own, -1).otherwise(bucket))
        return dim.repartition(*parts), parts

    if not tables.exists(name) or tables.read(name).isEmpty():
        dim, parts = stored(scd2.scd2_history(good, keys, spec))
        tables.replace(name, dim, parts)
        return
    known = tables.read(name)
    by_bucket = bool(spec.buckets) and tables.partition_columns(name) == [BUCKET, spec.current_flag] and not set(good.columns) - set(known.columns)
    if by_bucket:
        touched = good.select(bucket.alias(BUCKET)).distinct()
        known = known.join(touched, BUCKET, "left_semi")
    known = known.drop(BUCKET)
    if contract.evolution == "strict":
        schema.evolve(known, good, "strict")
    if spec.timestamp:
        dim = scd2.scd2_apply(known, good, keys, spec)
    else:
        today = (now or datetime.now(timezone.utc)).strftime("%Y-%m-%d %H:%M:%S")
        dim = scd2.scd2_snapshot_apply(known, good, keys, spec, today)
    dim, parts = stored(dim)
    if by_bucket:
        # A key always has an open version, and versions are never dropped, so no folder can become empty.
        tables.overwrite_partitions(name, dim)
    else:
        tables.replace(name, dim, parts)


def run_contract(spark: SparkSession, contract: Contract, tables: Tables,
                 inputs: Mapping[str, DataFrame] | None = None, *, landing_root: str | None = None,
                 run_id: str | None = None, salt: str = "", dry_run: bool = False, once: bool = False,
                 reprocess: Mapping | None = None, fail_on_quarantine: bool = False, fail_on_dataset_rule: bool = False, fail_on_cast: bool = False,
                 window: tuple[datetime, datetime] | None = None, pipeline_run_id: str | None = None,
                 now: datetime | None = None, environment: str = "dev",
                 levels: Mapping[tuple[str, str], service_levels.Levels] | None = None) -> RunResult:
    """Execute a contract.

    The log row of the run has its cost, the newest change in its source, the bad rows by severity of the broken rules and, where
    ``levels`` are given by (domain, layer), how it stands against them. ``now`` is the moment the run is taken to start at.

    Without ``inputs`` an incremental landing source gives the files not taken yet, as a file stream; ``window`` reads the
    time folders between two moments instead, taken or not.

    The checked rows are written once to the shared scratch folder, split into good
    and bad. That is the only pass over the source: both outputs and all counts come
    from it, and a lost executor costs at most the tasks it ran. ``reprocess`` limits the
    source to a slice, as the arguments of ``reprocess_slice``.

    Text that does not fit its declared type becomes NULL. It is kept, as JSON by column, in ``_uncast`` of the stored
    row, and such rows are counted as ``uncast``; with ``fail_on_cast`` they are bad rows.

    Whether a run fails for its bad rows is known before anything is stored: a failed run adds to quarantine only.
    While a run writes it holds a claim with a heartbeat. A run that breaks off, by an error or with its driver, leaves its claim,
    and the next run of the contract, or the same one again, first removes the rows it left, by their run id. Runs at work
    are left alone: those that append go side by side, those that rewrite the table wait for each other. Stored tables are
    looked at for old rows only where a claim or the log says that there can be any.
    """
    apply_settings(spark)
    if inputs is None and window is None and is_incremental(contract):
        return _take_new_files(spark, contract, tables, landing_root, run_id, dry_run, salt=salt, reprocess=reprocess,
                               fail_on_quarantine=fail_on_quarantine, fail_on_dataset_rule=fail_on_dataset_rule, fail_on_cast=fail_on_cast, now=now,
                               environment=environment, levels=levels)
    given = run_id is not None
    run_id = run_id or new_run_id()
    before = attempts(tables, contract.name, [run_id] if given else [])
    if once and "success" in before.get(run_id, ()):
        return RunResult(contract.name, contract.layer, "skipped")
    started, clock = now or datetime.now(timezone.utc), time.monotonic()
    inputs = dict(inputs or resolve_inputs(spark, contract, tables, landing_root, window))
    if reprocess:
        inputs = {**inputs, "source": reprocess_slice(inputs["source"], **reprocess)}
    seen, checked = Observation(), Observation()
    plan = compile_contract(contract, inputs, observation=seen, cast_checks=fail_on_cast, salt=salt)
    from_files = SOURCE_FILE in plan.columns
    mtime = F.max(F.col(SOURCE_MTIME).cast("double")) if SOURCE_MTIME in plan.columns else F.max(F.lit(None).cast("double"))
    plan = plan.observe(
        checked, F.count(F.lit(1)).alias("total"),
        F.count_if(F.size(quality.ERRORS) == 0).alias("good"), mtime.alias("mtime"),
        F.count(F.col(schema.UNCAST) if schema.UNCAST in plan.columns else F.lit(None)).alias("uncast"),
        _newest_change(contract, plan).alias("changed"), quality.bad_by_severity(contract.rules).alias("bad_by_severity"),
    )
    source_column = F.col(SOURCE_FILE) if from_files else None
    plan = stamp(plan, contract, run_id, F.lit(started), source=source_column).drop(*_HELPERS)
    plan = plan.withColumn("_bad", F.size(quality.ERRORS) > 0)
    staged = scratch_path(spark, contract.name)
    log = dict(
        run_id=run_id, pipeline_run_id=pipeline_run_id or run_id, contract=contract.name, contract_version="1.0.0", stage="run", dataset=contract.name,
        domain=contract.domain, system=contract.system or None, environment=environment, data_layer=contract.layer, start_time=started.isoformat(), source_path=contract.source.path)
    try:
        if dry_run:
            plan.write.format("noop").mode("overwrite").save()
        else:
            plan.write.partitionBy("_bad").parquet(staged)
        if contract.transform:  # what comes out of a transform says nothing of what went in
            counts = {"source": inputs["source"].count(), **checked.get}
        else:
            counts = {"source": seen.get["rows"], **checked.get}
        changed, bad_by_severity = counts.pop("changed"), counts.pop("bad_by_severity").asDict()
        good_rows, bad_rows = counts["good"], counts["total"] - counts["good"]
        report = {}
        refused = bool(fail_on_quarantine and bad_rows)
        if not dry_run:
            _remove_traces(tables, contract, run_id if given else None, bool(before))
            with tables.claims.held(contract.name, run_id, wait=2 * LEASE):
                rows = spark.read.schema(plan.schema).parquet(staged)
                drop = (quality.ERRORS, schema.UNKNOWN, "_bad", *([] if counts["uncast"] else [schema.UNCAST]))
                good = privacy.apply_masks(rows.filter(~F.col("_bad")).drop(*drop), contract, salt)
                if bad_rows:
                    bad = privacy.apply_masks(rows.filter("_bad").drop("_bad"), contract, salt)
                    tables.append(f"quarantine_{contract.name}", bad)
                if not refused:
                    # A rewrite reads what it replaces, so two of them must not overlap.
                    with tables.writer(contract.name) if contract.strategy != "append" else nullcontext():
                        materialize(contract, tables, good, started)
                    for keys in contract.unique:
                        check = quality.unique_report(tables.read(contract.name), keys).first()
                        report[check["rule"]] = check["passed"]
                failed_rules = [k for k, passed in report.items() if not passed]
                status = "failed" if refused or (fail_on_dataset_rule and failed_rules) else "success"
                seconds = time.monotonic() - clock
                # Logged before the claim ends: a run that is in the log needs no cleaning, whatever happens next.
                append_run(
                    tables, levels, **log, status=status, end_time=(started + timedelta(seconds=seconds)).isoformat(), run_duration_seconds=seconds,
                    max_watermark_value=None if changed is None else changed.isoformat(),
                    report_json=json.dumps({"bad_by_severity": bad_by_severity, "uncast": counts["uncast"], "dataset_rules": report}),
                    error_message=f"{bad_rows} rows failed the checks" if refused else f"broken: {failed_rules}" if status == "failed" else None,
                    counts_source=counts["source"], counts_total=counts["total"], counts_good=good_rows, counts_quarantined=bad_rows,
                    quarantine_ratio=bad_rows / counts["total"] if counts["total"] else 0.0, max_source_mtime=counts["mtime"])
    except Exception as error:
        if not dry_run:
            seconds = time.monotonic() - clock
            append_run(tables, **log, status="failed", error_message=f"{type(error).__name__}: {error}"[:2000],
                       end_time=(started + timedelta(seconds=seconds)).isoformat(), run_duration_seconds=seconds)
        raise
    finally:
        _remove(spark, staged)
    if dry_run:
        status = "failed" if refused else "success"
    return RunResult(contract.name, contract.layer, status, good_rows, bad_rows, {**counts, **report}, refused)


def _newest_change(contract: Contract, plan: DataFrame) -> Column:
    """The newest value of the first change column, as far as it is a moment."""
    name = next((c for c in contract.change_columns if c in plan.columns), None)
    return F.max(F.col(name).try_cast("timestamp")) if name else F.max(F.lit(None).cast("timestamp"))


def _remove_traces(tables: Tables, contract: Contract, run_id: str | None, logged: bool) -> None:
    """Remove the rows of runs that have broken off, and of an earlier attempt of this run. Runs at work are not touched."""
    left = set(tables.claims.broken(contract.name))
    again = {run_id} if run_id is not None and (tables.claims.wait_until_free(contract.name, run_id) or logged) else set()
    done = {r for r, statuses in attempts(tables, contract.name, sorted(left - again)).items() if "success" in statuses}
    for name in (contract.name, f"quarantine_{contract.name}"):
        if contract.strategy == "append" or name != contract.name:
            tables.forget_runs(name, STAMP_RUN, sorted((left - done) | again))
    for old in left - again:
        tables.claims.release(contract.name, old)


def _remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def select_contracts(contracts: Iterable[Contract], *, layers: Iterable[str] | None = None,
                     entities: Iterable[str] | None = None, domains: Iterable[str] | None = None) -> list[Contract]:
    """The registered contracts of a run, bronze before silver before gold."""
    rank = {"bronze": 0, "silver": 1, "gold": 2}
    wanted = None if entities is None else {e.removeprefix("fact_").removeprefix("dim_") for e in entities}
    chosen = [
        c for c in contracts
        if c.registered
        and (layers is None or c.layer in set(layers))
        and (domains is None or c.domain in set(domains))
        and (entities is None or entity_of(c) in wanted)
    ]
    return sorted(chosen, key=lambda c: rank[c.layer])


def entity_of(contract: Contract) -> str:
    """The name without layer and kind of table: what a run is asked for by."""
    name = contract.name
    for prefix in (f"{contract.layer}_", "shared_", "fact_", "dim_"):
        name = name.removeprefix(prefix)
    return name


def provision(tables: Tables, contracts: Iterable[Contract]) -> None:
    """Create the declared tables empty, with the lineage columns that every run adds."""
    stamps = [T.StructField(STAMP_SOURCE, T.StringType()), T.StructField(STAMP_TIME, T.TimestampType()),
              T.StructField(STAMP_RUN, T.StringType()), T.StructField(STAMP_CONTRACT, T.StringType())]
    for c in contracts:
        own = c.to_struct_type().fields
        tables.create_empty(c.name, T.StructType([*own, *[s for s in stamps if s.name not in {f.name for f in own}]]), c.partition_by)


def reset_layers(tables: Tables, contracts: Iterable[Contract], *, reload_only: bool = False) -> None:
    """Before a rebuild: forget the tables, or with ``reload_only`` just empty them."""
    for c in contracts:
        if tables.exists(c.name):
            tables.truncate(c.name) if reload_only else tables.drop(c.name)
