"""Small files that say which data counts, written whole and never over another one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHREDDING = "spark.sql.variant.writeShredding.enabled"


def shared_folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir, which all executors reach."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, shredded: bool = True) -> DataFrame:
    """df as a table in the shared folder: what is read several times is worked out once. A VARIANT that is not shredded stays one value,
    which is no table of its fields that each reader puts together again."""
    path, conf = shared_folder(df.sparkSession), df.sparkSession.conf
    was = conf.get(SHREDDING, None)
    if not shredded:
        conf.set(SHREDDING, "false")
    try:
        df.write.parquet(path)
    finally:
        if not shredded:
            conf.unset(SHREDDING) if was is None else conf.set(SHREDDING, was)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at(self.path).toUri(), conf)
        self._plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def names(self) -> list[str]:
        at = self._at(self.path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at) if not s.getPath().getName().startswith((".", "_"))) if self._fs.exists(at) else []

    def put_new(self, name: str, text: str) -> bool:
        """False, and nothing written, if the name is taken: of two writers one gets it."""
        self._fs.mkdirs(self._at(self.path))
        aside, final = self._at(f"{self.path}/.{uuid.uuid4().hex}"), self._at(f"{self.path}/{name}")
        out = self._fs.create(aside)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self._context.rename(aside, final, self._plain)  # fails where the name exists
            return True
        except Exception:
            if not self._fs.exists(final):
                raise
            self._fs.delete(aside, False)
            return False

    def read(self, name: str) -> str:
        source = self._fs.open(self._at(f"{self.path}/{name}"))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(f"{self.path}/{name}"), True)
