"""Matrices with a row a sample and few columns, as one file for so many rows each in the shared folder.

Tasks read and write them part by part, and what comes back to the driver are products with a row and a column for each
column. So the driver holds none of them, however many samples there are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from gridloom.session import shared_folder
from gridloom.sources.bgzip import filesystem

#: Rows in a file.
ROWS = 1 << 14


@dataclass(frozen=True)
class Tall:
    """n rows of width doubles in the files 0, 1, ... of path."""

    path: str
    n: int
    width: int
    rows: int = ROWS

    @property
    def parts(self) -> int:
        return -(-self.n // self.rows)

    def size(self, part: int) -> int:
        return min(self.rows, self.n - part * self.rows)

    def read(self, part: int) -> np.ndarray:
        files, at = filesystem(self.path)
        with files.open_input_file(f"{at}/{part}") as f:
            return np.frombuffer(f.read()).reshape(self.size(part), self.width)

    def write(self, part: int, x: np.ndarray) -> None:
        """A file has its name once it is whole, so a task may run again."""
        files, at = filesystem(self.path)
        name = f"{at}/_{part}-{uuid.uuid4().hex}"
        with files.open_output_stream(name) as f:
            f.write(np.ascontiguousarray(x, float).tobytes())
        files.move(name, f"{at}/{part}")

    def columns(self) -> np.ndarray:
        """All columns, each in one piece, for a task that needs any row."""
        out = np.empty((self.width, self.n))
        for part in range(self.parts):
            out[:, part * self.rows : (part + 1) * self.rows] = self.read(part).T
        return out

    def whole(self) -> np.ndarray:
        """All rows, for a task that needs any of them."""
        out = np.empty((self.n, self.width))
        for part in range(self.parts):
            out[part * self.rows : (part + 1) * self.rows] = self.read(part)
        return out

    def drop(self) -> None:
        files, at = filesystem(self.path)
        files.delete_dir(at)


class Noise(Tall):
    """Normal random numbers, the same ones whenever they are read."""

    def read(self, part: int) -> np.ndarray:
        return np.random.default_rng([0, part]).normal(size=(self.size(part), self.width))


def tall(spark: SparkSession, n: int, width: int, rows: int = ROWS) -> Tall:
    """A matrix whose files are still to be written."""
    out = Tall(shared_folder(spark, "tall"), n, width, rows)
    files, at = filesystem(out.path)
    files.create_dir(at, recursive=True)
    return out


def each_part(spark: SparkSession, parts: int, f: Callable[[int], np.ndarray]) -> list[np.ndarray]:
    """f of every part, flat: small arrays for the driver. What is one part only is done by the driver itself."""
    if parts == 1:
        return [np.ascontiguousarray(f(0), float).ravel()]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in b.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.ascontiguousarray(f(part), float).tobytes()], pa.binary())], names=["part", "x"])

    tasks = max(1, min(parts, 2 * spark.sparkContext.defaultParallelism))
    found = spark.range(0, parts, 1, tasks).mapInArrow(kernel, "part long, x binary").toArrow().sort_by("part")
    return [np.frombuffer(x.as_buffer()) for x in found["x"]]


def mix(spark: SparkSession, terms: list[tuple[Tall, np.ndarray]], out: Tall, against: list[Tall]) -> tuple[np.ndarray, np.ndarray]:
    """Write the sum of the matrices times their coefficients to out; (products of the columns of against with it, its Gram matrix)."""

    def one(part: int) -> np.ndarray:
        known = {m.path: m.read(part) for m in {*(m for m, _ in terms), *against}}
        x = sum(known[m.path] @ c for m, c in terms)
        out.write(part, x)
        return np.vstack([*(known[q.path].T @ x for q in against), x.T @ x])

    all_ = sum(each_part(spark, out.parts, one)).reshape(-1, out.width)
    return all_[: -out.width], all_[-out.width :]


def split(basis: list[Tall], c: np.ndarray) -> list[tuple[Tall, np.ndarray]]:
    """Each matrix of the basis with its rows of c."""
    ends = np.cumsum([q.width for q in basis])
    return [(q, c[e - q.width : e]) for q, e in zip(basis, ends)]


def orthonormal(spark: SparkSession, x: Tall, basis: list[Tall], across: np.ndarray, gram: np.ndarray, floor: float, room: int) -> Tall | None:
    """An orthonormal basis of what x has beside the basis, of room columns at most; columns no longer than floor are left out.

    across and gram are the products of the basis with x and of x with itself. Columns are scaled before the Gram matrix
    is decomposed, and this is repeated until the products show that the result is orthonormal.
    """
    given = x
    for _ in range(4):
        g = gram - across.T @ across
        size = np.sqrt(np.maximum(np.diag(g), 0))
        some = np.flatnonzero(size > floor)
        if not len(some) or not room:
            return None
        w, u = (a[..., ::-1] for a in np.linalg.eigh(g[np.ix_(some, some)] / np.outer(size[some], size[some])))
        keep = np.flatnonzero(w > 1e-12 * w[0])[:room]
        turn = np.zeros((x.width, len(keep)))
        turn[some] = u[:, keep] / np.sqrt(w[keep]) / size[some, None]
        out = tall(spark, x.n, len(keep), x.rows)
        across, gram = mix(spark, [(x, turn), *split(basis, -across @ turn)], out, basis)
        if x is not given:
            x.drop()
        x, floor = out, 0
        if max(np.abs(across).max(initial=0), np.abs(gram - np.eye(x.width)).max()) < 1e-12:
            break
    return x
