"""Where the registered queries put the tables they write and read back."""

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``, or else in the session's warehouse; both
    are shared on a cluster. What is there goes when the driver's JVM ends."""
    base = (spark.conf.get("spark.checkpoint.dir", None)
            or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop_path)
    files.deleteOnExit(hadoop_path)
    return path
