"""What the operators of this folder share: the list of queries, reading, word splitting on bytes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Documents differ in length by a factor of thousands; small Arrow batches keep Python workers small.
ARROW_ROWS = 1000

#: ASCII capitals to small letters, on UTF-8 bytes; all other bytes stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once an application, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parents[1]
        archive = Path(tempfile.mkdtemp(prefix="contractflow-")) / "contractflow.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for path in sorted(package.rglob("*.py")):
                z.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def settings(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def query(name: str, sql: str | None = None):
    """Register a function of a session and a data folder, and the SQL that must give the same rows."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(settings(spark), sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Runs of bytes other than blank and \\x09 to \\x0D, with A-Z in lower case.

    ``bytes.split`` breaks at exactly these six bytes, so no regular expression is needed.
    """
    return text.translate(LOWER).split()


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, whatever the session's batch size is."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
