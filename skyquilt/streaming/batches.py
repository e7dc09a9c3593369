"""Batch-by-batch iteration over a job, with the next batch prepared while one is in use."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.job import CutoutJob


class CutoutStream:
    """init_streaming(), then next_batch() until IndexError, or get_batch(i) in any order.

    A batch is the driver's unit: its rows fit the driver by the batch size asked for. With synchronised loading a
    batch is made when asked for; else one batch is made ahead, in a thread that waits on Spark.
    """

    def __init__(self, job: CutoutJob) -> None:
        self.job, self.rows = job, None
        self.count = self.place = 0
        self.pool: ThreadPoolExecutor | None = None
        self.ahead: tuple[int, Future] | None = None

    def init_streaming(self, source: str | DataFrame, batch_size: int, synchronised_loading: bool = True, write_to_disk: bool = False) -> int:
        self.rows = self.job.batched(self.job.catalogue(source), batch_size).persist()
        self.count = (self.rows.agg(F.max("batch")).first()[0] or 0) + 1 if not self.rows.isEmpty() else 0
        self.place, self.disk = 0, write_to_disk
        self.pool = None if synchronised_loading else ThreadPoolExecutor(1)
        self._prepare(0)
        return self.count

    def get_batch_count(self) -> int:
        return self.count

    def _prepare(self, i: int) -> None:
        if self.pool is not None and i < self.count:
            self.ahead = (i, self.pool.submit(self._make, i))

    def _make(self, i: int) -> dict[str, Any]:
        own = self.rows.where(F.col("batch") == i)
        images = self.job.images(own)
        if self.disk:
            path = f"{self.job.config['output_dir']}/stream_{i:03d}"
            images.write.mode("overwrite").parquet(path)
            return {"batch_number": i + 1, "path": path, "metadata": self.job.spark.read.parquet(path).drop("images", "wcs").orderBy("batch_index").toPandas().to_dict("records")}
        out = images.orderBy("batch_index").toPandas()
        stack = np.stack([np.stack([np.asarray(p, np.float32).reshape(s, s) for p in planes], axis=-1) for planes, s in zip(out["images"], out["size"], strict=True)]) if len(out) else np.zeros((0, 0, 0, 0), np.float32)
        return {"batch_number": i + 1, "cutouts": stack, "metadata": out.drop(columns=["images", "wcs"]).to_dict("records")}

    def get_batch(self, i: int) -> dict[str, Any]:
        if self.rows is None:
            raise RuntimeError("init_streaming() comes first")
        if not 0 <= i < self.count:
            raise IndexError(f"batch {i} of {self.count}")
        if self.ahead and self.ahead[0] == i:
            future, self.ahead = self.ahead[1], None
            return future.result()
        return self._make(i)

    def next_batch(self) -> dict[str, Any]:
        out = self.get_batch(self.place)
        self.place += 1
        self._prepare(self.place)
        return out

    def __iter__(self) -> Iterator[dict[str, Any]]:
        while self.place < self.count:
            yield self.next_batch()

    def cleanup(self) -> None:
        if self.pool is not None:
            self.pool.shutdown(cancel_futures=True)
        if self.rows is not None:
            self.rows.unpersist()
        self.rows, self.count, self.ahead = None, 0, None
