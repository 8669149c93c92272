"""The churn table as a published source: written by one run, read by others.

    {root}/data/{version}-{id}/   the rows of one publication (parquet)
    {root}/versions/{version}     its marker: where the rows are, their number, schema and as-of time

A publication is written, read back and validated, and only then becomes current: its
marker is created under the next free number, which the file system refuses if another
run has taken it.  Readers take the highest marker, so they see one whole publication or
the one before, never a part; a failed or lost run leaves at most data that no marker
names.  Markers hold a line of JSON and are listed, never the data.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIME = ("timestamp_ntz", "timestamp", "date")
#: Columns that the bridges read with their types, and what a published row must satisfy.
COLUMNS = {
    "entity_id": ("bigint",), "entity_type": ("string",), "user_ids": ("bigint",), "pickup_date": TIME, "payment_date": TIME,
    "transaction_type": ("string",), "churn_flag": ("string",), "start_date": TIME, "end_date": TIME,
    "taxable_amount": ("decimal(18,2)",), "rnk": ("int",), "refreshed_at": TIME,
}
RULES = {
    "entity without id": "entity_id IS NULL",
    "unknown entity type": "entity_type IS NULL OR entity_type NOT IN ('ITEM', 'ATTACHMENT')",
    "unknown churn flag": "churn_flag IS NULL OR churn_flag NOT IN ('FULL', 'PARTIAL')",
    "rank below 1": "rnk IS NULL OR rnk < 1",
    "no refresh time": "refreshed_at IS NULL",
}


class PublishError(RuntimeError):
    """The rows were not published; what was current before still is."""


class StaleSource(RuntimeError):
    """The published table is missing, of another schema or not of the wanted time."""


def _misfits(df: DataFrame) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c, known in COLUMNS.items() if kinds.get(c) not in known]


class ChurnStore:
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    # ---- files ---------------------------------------------------------------
    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path

    def versions(self, spark: SparkSession) -> list[int]:
        fs, path = self._fs(spark)
        folder = path(f"{self.root}/versions")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def marker(self, spark: SparkSession, version: int) -> dict:
        fs, path = self._fs(spark)
        stream = fs.open(path(f"{self.root}/versions/{version:012d}"))
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _claim(self, spark: SparkSession, version: int, marker: dict) -> None:
        """Create the marker; an error if the number is taken."""
        fs, path = self._fs(spark)
        fs.mkdirs(path(f"{self.root}/versions"))
        stream = fs.create(path(f"{self.root}/versions/{version:012d}"), False)
        try:
            stream.write(bytearray(json.dumps(marker).encode()))
        finally:
            stream.close()

    def _delete(self, spark: SparkSession, name: str) -> None:
        fs, path = self._fs(spark)
        fs.delete(path(f"{self.root}/{name}"), True)

    # ---- publish -------------------------------------------------------------
    def publish(self, df: DataFrame, least_rows: int = 0) -> int:
        """Write, validate and switch; the version that is now current."""
        spark = df.sparkSession
        if missing := _misfits(df):
            raise PublishError(f"columns missing or of another type: {missing}")
        version = max(self.versions(spark), default=0) + 1
        name = f"data/{version:012d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{name}")
        try:
            times = self._validate(spark.read.parquet(f"{self.root}/{name}"), least_rows)
            self._claim(spark, version, {"data": name, "schema": df.schema.json(), **times})
        except (PublishError, PySparkException) as error:
            self._delete(spark, name)
            raise error if isinstance(error, PublishError) else PublishError(str(error)) from error
        except Exception as error:  # the marker's number is taken by another run
            self._delete(spark, name)
            raise PublishError(f"version {version} was published by another run") from error
        return version

    def _validate(self, written: DataFrame, least_rows: int) -> dict:
        checks = [F.count(F.when(F.expr(rule), 1)).alias(name) for name, rule in RULES.items()]
        row = written.agg(
            F.count("*").alias("rows"), F.min("refreshed_at").cast("string").alias("first"), F.max("refreshed_at").cast("string").alias("last"), *checks
        ).first()
        faults = {name: row[name] for name in RULES if row[name]}
        if row["first"] != row["last"]:
            faults["rows of several refresh times"] = f"{row['first']} to {row['last']}"
        if row["rows"] < least_rows:
            faults["rows"] = f"{row['rows']} of at least {least_rows}"
        if faults:
            raise PublishError(f"not published: {faults}")
        return {"rows": row["rows"], "refreshed_at": row["last"]}

    # ---- read ----------------------------------------------------------------
    def read(self, spark: SparkSession, refreshed_at: dt.date | None = None, version: int | None = None) -> DataFrame:
        """The current publication (or a kept `version`), checked against its marker.  With
        `refreshed_at` it must have been made as of that day (an empty one has no day)."""
        have = self.versions(spark)
        if not have or (version is not None and version not in have):
            raise StaleSource(f"nothing published under {self.root}" if not have else f"version {version} is not kept: {have}")
        marker = self.marker(spark, version or have[-1])
        own = marker["refreshed_at"]
        if refreshed_at is not None and own is not None and dt.datetime.fromisoformat(own).date() != refreshed_at:
            raise StaleSource(f"published as of {own}, wanted {refreshed_at}")
        df = spark.read.parquet(f"{self.root}/{marker['data']}")
        if wrong := _misfits(df):
            raise StaleSource(f"columns missing or of another type: {wrong}")
        return df

    def keep(self, spark: SparkSession, newest: int) -> None:
        """Forget all but the newest publications: markers first, so that none names deleted rows."""
        for version in self.versions(spark)[: -max(1, newest)]:
            data = self.marker(spark, version)["data"]
            self._delete(spark, f"versions/{version:012d}")
            self._delete(spark, data)
