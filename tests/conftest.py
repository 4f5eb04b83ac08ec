import os
import sys
import tempfile

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.matrix import Matrix  # noqa: E402
from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="tessera-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s
    s.stop()


def to_dense(m: Matrix, shape=None) -> np.ndarray:
    pdf = m.df.toPandas()
    r, c = shape or (m.n_rows, m.n_cols)
    out = np.zeros((r, c))
    if len(pdf):
        np.add.at(out, (pdf["row"].to_numpy(), pdf["col"].to_numpy()), pdf["value"].to_numpy().astype(float))
    return out


def from_dense(spark, arr, value_type="double") -> Matrix:
    arr = np.asarray(arr)
    rows = [(int(i), int(j), (int(arr[i, j]) if value_type == "bigint" else float(arr[i, j])))
            for i in range(arr.shape[0]) for j in range(arr.shape[1]) if arr[i, j] != 0]
    vt = "bigint" if value_type == "bigint" else "double"
    df = spark.createDataFrame(rows, f"row int, col int, value {vt}")
    return Matrix(df, arr.shape[0], arr.shape[1])


def ma(n, m=None):
    m = n if m is None else m
    i, j = np.meshgrid(np.arange(n), np.arange(m), indexing="ij")
    return (i * 31 + j * 17 + i * j * 7) % 100


def mb(n, m=None):
    m = n if m is None else m
    i, j = np.meshgrid(np.arange(n), np.arange(m), indexing="ij")
    return (i * 13 + j * 29 + i * j * 7) % 100
