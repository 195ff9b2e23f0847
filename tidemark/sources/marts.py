"""Storage of finished tables: a rebuild becomes visible when it is complete, or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Names the version that readers see; one line.
CURRENT = "_CURRENT"
KEPT_VERSIONS = 2


class _Folder:
    """The versions of one mart, on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self._at("").getFileSystem(conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def current(self) -> str | None:
        """The committed version, or None where there is no pointer."""
        if not self.files.exists(self._at(CURRENT)):
            return None
        stream = self.files.open(self._at(CURRENT))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def commit(self, version: str) -> None:
        """Point readers to a version by one rename; a reader finds the old or the new pointer."""
        fresh = self._at(f"{CURRENT}-{version}")
        stream = self.files.create(fresh, True)
        stream.write(version.encode())
        stream.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        overwrite = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        overwrite[0] = options.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri())
        context.rename(fresh, self._at(CURRENT), overwrite)

    def drop_old(self, kept: int = KEPT_VERSIONS) -> None:
        """Remove all but the committed and the last few versions, which readers may still use."""
        committed = self.current()
        found = [s for s in self.files.listStatus(self._at("")) if s.isDirectory()]
        versions = [s for s in found if s.getPath().getName().startswith("version-")]
        versions.sort(key=lambda s: (s.getPath().getName() == committed, s.getModificationTime()))
        for status in versions[: max(0, len(versions) - kept)]:
            self.files.delete(status.getPath(), True)


def write_mart(df: DataFrame, directory: str, name: str) -> DataFrame:
    """Fully rebuild ``<directory>/<name>`` and return a frame over the stored rows.

    The rows go to a folder of their own; only when all are written does the pointer name it, so a
    job that fails leaves the earlier table as it was. The version before the last is removed.
    The rebalance hint lets AQE even out file sizes, splitting large and merging small ones.
    """
    spark, version = df.sparkSession, f"version-{uuid.uuid4().hex}"
    df.hint("rebalance").write.parquet(f"{directory}/{name}/{version}")
    folder = _Folder(spark, f"{directory}/{name}")
    folder.commit(version)
    folder.drop_old()
    return read_mart(spark, directory, name)


def read_mart(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The committed version; a folder without a pointer is read as it is."""
    version = _Folder(spark, f"{directory}/{name}").current()
    return spark.read.parquet(f"{directory}/{name}/{version}" if version else f"{directory}/{name}")


def save_as_table(df: DataFrame, name: str) -> DataFrame:
    """Fully rebuild a catalog table."""
    df.hint("rebalance").write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
