"""Tables kept as Parquet under a key and a freshness token."""

from __future__ import annotations

import hashlib
import logging
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


_log = logging.getLogger(__name__)


class TableCache:
    """A folder of kept tables, in the file system of the session.

    An entry's key is the dataset, version and kind with a hash of what else the table depends on; the token says which state of the source it
    shows. A new token supersedes the entry's older states. ``enabled=False`` computes every time.
    """

    def __init__(self, spark: SparkSession, root: str, enabled: bool = True):
        self.spark, self.root, self.enabled = spark, root.rstrip("/"), enabled

    @classmethod
    def of_session(cls, spark: SparkSession) -> TableCache | None:
        """The cache that the session's settings name: ``spark.axonframe.cache.dir``, unless ``spark.axonframe.cache.enabled`` is false; None without a folder."""
        root = spark.conf.get("spark.axonframe.cache.dir", None)
        return cls(spark, root, spark.conf.get("spark.axonframe.cache.enabled", "true").lower() != "false") if root else None

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def folder(self, dataset: str, version: object, kind: str, *parts: object) -> str:
        digest = hashlib.sha256(repr(parts).encode()).hexdigest()[:12]
        clean = [re.sub(r"[^A-Za-z0-9._-]", "_", str(x)) for x in (dataset, version, kind)]
        return "/".join([self.root, *clean, digest])

    def get(self, folder: str, token: str | None, make: Callable[[], DataFrame]) -> DataFrame:
        """The kept table, or ``make()`` written and read back. Without a token a kept table never ages. A write that did not finish
        left no success mark and counts as missing."""
        if not self.enabled:
            _log.info("%s: made, as nothing is kept", folder)
            return make()
        state = hashlib.sha256((token or "").encode()).hexdigest()[:16]
        path = f"{folder}/{state}"
        fs, mark = self._fs(f"{path}/_SUCCESS")
        kept = fs.exists(mark)
        _log.info("%s: %s", folder, "kept" if kept else "made, as it is not there in this state")
        if not kept:
            make().write.mode("overwrite").parquet(path)
            self._supersede(folder, state)
        return self.spark.read.parquet(path)

    def _supersede(self, folder: str, keep: str) -> None:
        fs, p = self._fs(folder)
        for f in fs.listStatus(p):
            if f.getPath().getName() != keep:
                fs.delete(f.getPath(), True)

    def clear(self, dataset: str | None = None) -> None:
        fs, p = self._fs(f"{self.root}/{re.sub(r'[^A-Za-z0-9._-]', '_', dataset)}" if dataset else self.root)
        if fs.exists(p):
            fs.delete(p, True)

    def size(self) -> int:
        """Bytes of all entries."""
        fs, p = self._fs(self.root)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0
