"""Episodes in HDF5 files, where the reader's library is installed."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def hdf5_steps(spark: SparkSession, path: str, fields: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """One row per file and step: ``path``, ``step`` and a vector per field; optional fields may be missing.

    A file whose fields differ in length fails the job.
    """
    try:
        import h5py  # noqa: F401
    except ImportError as e:
        raise ImportError("h5py is needed to read HDF5 files") from e
    names = {f: f.strip("/").replace("/", "_") for f in [*fields, *optional]}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import h5py

        for batch in batches:
            for where, content in zip(batch["path"], batch["content"]):
                with h5py.File(io.BytesIO(content), "r") as f:
                    held = {n: f[k][:] for k, n in names.items() if k in f or k in fields}
                lengths = {len(v) for v in held.values()}
                if len(lengths) != 1:
                    raise ValueError(f"{where}: fields of {sorted(lengths)} steps")
                n = lengths.pop()
                yield pd.DataFrame({"path": where, "step": range(n)} | {c: [[float(x) for x in v.ravel()] for v in held[c]] if c in held else [None] * n for c in names.values()})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.hdf5").load(path).select("path", "content")
    return files.mapInPandas(read, "path string, step bigint, " + ", ".join(f"`{n}` array<double>" for n in names.values()))
