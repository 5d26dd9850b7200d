"""The registry that the query modules fill."""

from __future__ import annotations

import tempfile
import unicodedata
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path that all executors see; a plain local session without a shared folder has a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors see")
        shared = "file://" + tempfile.mkdtemp(prefix="presslens-")
    return f"{shared.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def norm_sql(text: str) -> str:
    """NFKD and lower case in SQL, for texts whose wide characters are Latin letters of up to U+017F."""
    for code in range(0xA0, 0x180):
        made = unicodedata.normalize("NFKD", chr(code))
        if made != chr(code) and chr(code).isalpha():
            text = f"replace({text}, '{chr(code)}', '{made}')"
    return f"lower({text})"
