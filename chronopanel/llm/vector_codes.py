"""Product codes of vectors, found through memoised grid cells.

Each component becomes floor(4096 c), and a vector is cut into equal parts.
Every part position has a codebook of 16 entries, improved by rounds of
assignment and integer means.

``CellMemo`` assigns parts. A part's coarse cell is the box of a grid that
holds it. For a cell seen for the first time the least and the greatest
distance between each entry and the box are computed; an entry whose least
distance exceeds another entry's greatest one is nearest to no point of the
box and is dropped. The entries left are remembered under the cell, and only
they are evaluated exactly. All arithmetic is on whole numbers, so neither the
memo's state nor the order of rows changes a result.

A round is one pass over the table: each task adds up the parts of every entry
and sends one row per entry and place; the sums, whose number is 16 x the
dimension, make the next codebooks on the driver.

Defined cases: rows whose vector is null or holds null or non-finite
components are dropped; rows that repeat an id each get a code; the first
entries come from the 16 smallest ids, among equal ids from the smallest
vectors, rows without id last; fewer than 16 rows give fewer entries, entries
that are equal leave the later ones unused; an empty table gives no rows; other
columns are ignored, whatever their names; vectors of different lengths, of a
length that the parts do not divide, or with components of 2^40 and more, are
an error; an error sum beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import sized, tidy, written
from .vectors import long_list, one_length, whole_numbers

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
MEMO_CELLS = 200_000
#: copies of each label's sum when labels are too many to broadcast
SALTS = 32


class CellMemo:
    """Nearest entries of one part position's codebook (entries x width)."""

    def __init__(self, book: np.ndarray, wide: bool = False):
        self.book = book.astype(object) if wide else book
        # a cell is about half as wide as the entries are spread
        spread = int(max((int(b) - int(a) for a, b in zip(book.min(0), book.max(0))), default=0))
        self.side = 1 << max(spread // 2, 1).bit_length()
        self.cells: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def candidates(self, corner: np.ndarray) -> np.ndarray:
        """For each cell (its lowest point): which entries may be nearest."""
        below = corner[:, None, :] - self.book[None]              # > 0: the entry lies below the box
        above = self.book[None] - (corner[:, None, :] + (self.side - 1))
        least = np.maximum(np.maximum(below, above), 0)
        most = np.maximum(abs(below), abs(above))
        least, most = (least * least).sum(2), (most * most).sum(2)
        return (least <= most.min(1)[:, None]).astype(bool)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part; the lowest of equal ones."""
        corner = np.ascontiguousarray(np.floor_divide(x, self.side) * self.side)
        keys = corner.view([("", corner.dtype)] * corner.shape[1])[:, 0]
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        names = [corner[k].tobytes() for k in first]
        new = [k for k, name in enumerate(names) if name not in self.cells]
        if len(self.cells) + len(new) > MEMO_CELLS:
            self.cells.clear()
            new = list(range(len(names)))
        for a in range(0, len(new), 4096):
            some = new[a: a + 4096]
            wide = self.book.dtype == object
            at = corner[first[some]].astype(object) if wide else corner[first[some]]
            self.cells.update(zip([names[k] for k in some], self.candidates(at)))
        open_ = np.array([self.cells[name] for name in names])[inverse]
        self.evaluated += int(open_.sum())
        best, error = np.full(len(x), -1), np.zeros(len(x), self.book.dtype)
        for k in range(len(self.book)):
            rows = np.flatnonzero(open_[:, k])
            diff = x[rows] - self.book[k]
            d = (diff * diff).sum(1)
            closer = (best[rows] < 0) | (d < error[rows])
            best[rows[closer]], error[rows[closer]] = k, d[closer]
        return best, error


def _too_wide(x: np.ndarray, books: np.ndarray) -> bool:
    """May squared distances leave the range of a long?"""
    top = float(max(np.abs(x).max(initial=0), np.abs(books).max(initial=0)))
    return (4 * top) ** 2 * max(x.shape[1], 1) >= 2.0 ** 62


class Coder:
    """Codes of vectors under given codebooks (parts x entries x width)."""

    def __init__(self, books: np.ndarray):
        self.books, self.memos = books, {}

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries and squared distances, one column a part."""
        parts, _, width = self.books.shape
        one_length(np.array([x.shape[1], parts * width]))
        wide = _too_wide(x, self.books)
        if wide not in self.memos:
            self.memos[wide] = [CellMemo(b, wide) for b in self.books]
        got = [m.nearest(np.ascontiguousarray(x[:, p * width: (p + 1) * width])) for p, m in enumerate(self.memos[wide])]
        return np.stack([g[0] for g in got], 1), np.stack([g[1] for g in got], 1)


def _first_rows(df: DataFrame, id_col: str, vec_col: str, scale: int, entries: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = whole_numbers(b.column("v"), scale)
            if len(rows):
                yield pa.record_batch([b.column("i").take(pa.array(rows)), long_list(x)], names=["i", "x"])

    kind = df.schema[id_col].dataType.simpleString()
    x = df.select(F.col(id_col).alias("i"), F.col(vec_col).alias("v")).mapInArrow(tidy(run), f"i {kind}, x array<long>")
    rows = x.orderBy(F.col("i").asc_nulls_last(), "x").limit(entries).collect()
    one_length(np.array([len(r["x"]) for r in rows]))
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), -1 if rows else 0)


def _round_sums(books: np.ndarray, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        parts, entries, width = books.shape
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), object)
        for b in batches:
            rows, x = whole_numbers(b.column("v"), scale)
            if not len(rows):
                continue
            code, _ = coder.assign(x)
            # components stay below 2^52, so a long holds the sums of 1024 rows
            for p in range(parts):
                count[p] += np.bincount(code[:, p], minlength=entries)
                for a in range(0, len(x), 1024):
                    some = np.zeros((entries, width), np.int64)
                    np.add.at(some, code[a: a + 1024, p], x[a: a + 1024, p * width: (p + 1) * width])
                    total[p] += some
        p, e, w = (i.reshape(-1) for i in np.indices(books.shape))
        used = count[p, e] > 0
        if used.any():
            yield pa.record_batch([pa.array(p[used], pa.int32()), pa.array(e[used], pa.int32()), pa.array(w[used], pa.int32()), pa.array(count[p, e][used]),
                                   pa.array([Decimal(int(v)) for v in total[p, e, w][used]], pa.decimal128(38, 0))], names=["p", "e", "w", "n", "s"])

    return run


def codebooks(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, parts: int = PARTS,
              entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts x entries x width) after the rounds; None if there is
    no usable vector."""
    first = _first_rows(df, id_col, vec_col, scale, entries)
    if not len(first):
        return None
    if first.shape[1] % parts:
        raise ValueError(f"{parts} equal parts do not divide {first.shape[1]} components")
    books = np.ascontiguousarray(first.reshape(len(first), parts, -1).transpose(1, 0, 2))
    vectors = df.select(F.col(vec_col).alias("v"))
    for _ in range(rounds):
        sums = (vectors.mapInArrow(tidy(_round_sums(books, scale)), "p int, e int, w int, n long, s decimal(38,0)")
                .groupBy("p", "e", "w").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
        books = books.copy()
        for r in sums:
            books[r["p"], r["e"], r["w"]] = int(r["s"]) // r["n"]
    return books


def codebook_hash(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def code(df: DataFrame, books: np.ndarray, id_col: str = "vec_id", vec_col: str = "embedding", keep=(), scale: int = SCALE) -> DataFrame:
    """id, the columns of ``keep``, code and error of every usable row."""
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        digits = np.array([f"{k:02x}" for k in range(books.shape[1])])
        for b in batches:
            rows, x = whole_numbers(b.column("v"), scale)
            if not len(rows):
                continue
            found, error = coder.assign(x)
            total = error.astype(object).sum(1) if error.size else np.zeros(len(x), object)
            at = pa.array(rows)
            yield pa.record_batch([*[b.column(k).take(at) for k in range(len(keep) + 1)],
                                   pa.array(["".join(r) for r in digits[found].tolist()], pa.string()),
                                   pa.array([int(t) if t < 1 << 63 else None for t in total], pa.int64())], names=[id_col, *keep, "code", "error"])

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in [id_col, *keep])
    return df.select(F.col(id_col), *keep, F.col(vec_col).alias("v")).mapInArrow(tidy(run), kinds + "code string, error long")


def with_group_sums(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over its rows of equal ``key`` (nulls
    are equal). Sums are broadcast if their number is small, else joined with
    ``SALTS`` copies of each, so that a hot key's rows spread."""
    sums = written(df.groupBy(F.col(key).alias("_k")).agg(F.sum(value).alias(out)), "group-sums")
    small = sized(sums)
    if small is not sums:
        return df.join(small, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")
    copies = sums.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64("code", value), F.lit(SALTS)).cast("int"))
    return salted.join(copies, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_salt") == F.col("_s")), "left").drop("_k", "_s", "_salt")


def coded_embeddings(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    books = codebooks(embeddings)
    if books is None:
        books = np.zeros((PARTS, 0, 0), np.int64)
    coded = written(code(embeddings, books, keep=["label"]), "vector-codes")
    out = with_group_sums(coded, "label", "error", "label_error")
    return out.select("vec_id", "code", "error", "label_error", F.lit(codebook_hash(books)).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL: the rounds written one after the other."""
    steps = [f"""k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS rid, vec_id, label, x, len(x) // {parts} AS w FROM (
    SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0) s)""",
             f"""v AS MATERIALIZED (SELECT rid, p, x[p * w + 1 : (p + 1) * w] AS part FROM k, range({parts}) r(p))""",
             f"""c0 AS MATERIALIZED (SELECT p, rid - 1 AS e, part AS entry FROM v WHERE rid <= {entries})"""]
    far = "list_sum(list_transform(list_zip(part, entry), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS BIGINT)))"
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, p, any_value(part) AS part, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT v.rid, v.p, v.part, c.e, {far} AS d FROM v JOIN c{i} c ON v.p = c.p) j GROUP BY rid, p)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.entry, c.entry) AS entry FROM c{i} c LEFT JOIN (
    SELECT p, e, list(val ORDER BY pos) AS entry FROM (
      SELECT p, e, pos, CAST(floor_div AS BIGINT) AS val FROM (
        SELECT p, e, pos, (s - ((s % n) + n) % n) // n AS floor_div FROM (
          SELECT p, e, pos, sum(val) AS s, count(*) AS n
          FROM (SELECT p, e, unnest(part) AS val, generate_subscripts(part, 1) AS pos FROM a{i}) u GROUP BY p, e, pos) t) f) g
    GROUP BY p, e) m ON c.p = m.p AND c.e = m.e)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY p, e, pos))
   FROM (SELECT p, e, unnest(entry) AS val, generate_subscripts(entry, 1) AS pos FROM c{rounds}) b) AS codebooks_sha256
FROM (SELECT any_value(k.vec_id) AS vec_id, any_value(k.label) AS label, string_agg(printf('%02x', a.e), '' ORDER BY a.p) AS code, sum(a.d) AS error
      FROM a{rounds} a JOIN k ON a.rid = k.rid GROUP BY a.rid) r"""


SQL = oracle()
