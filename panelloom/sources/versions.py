"""Tables that persist between batches: numbered versions in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Versions:
    """Numbered versions of a table in a folder; the latest complete one counts. A version that is there is not written again."""

    def __init__(self, spark: SparkSession, folder: str, schema: str) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _numbers(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        ok = lambda n: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}/_SUCCESS"))
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and ok(n))

    def before(self, number: int) -> DataFrame:
        """The latest version below ``number``."""
        return self._read([n for n in self._numbers() if n < number])

    def latest(self) -> DataFrame:
        return self._read(self._numbers())

    def _read(self, got: list[int]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/v{got[-1]}") if got else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/v{number}")

    def has(self, number: int) -> bool:
        return number in self._numbers()

    def advance(self, step, number: int | None = None) -> DataFrame:
        """The next version (or version ``number``, unless it is there): ``step`` of the latest one, written and read back."""
        at = number if number is not None else (self._numbers() or [0])[-1] + 1
        if not self.has(at):
            self.write(step(self.latest()), at)
        return self.latest()
