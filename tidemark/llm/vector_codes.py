"""Vector code compression: vectors as four bytes, by codebooks of whole numbers that are refined in rounds.

Components become floor(1024 x), vectors four parts, and each part the number of its nearest codebook entry (squared
Euclidean distance, ties to the lower number). Assignment screens by a float32 matrix product: with u = 2^-24 and d
components, the product differs from the true one by at most gamma(d + 2) |x| |c| whatever the order of its sum, so
every distance lies in a known interval. An entry whose interval overlaps the one with the least upper end is worked out
again in int64; the least exact distance wins, then the lower number. Entries equal to an earlier one can never win
and are not screened. So results are exact whatever the machine's arithmetic.

A round is one pass: tasks add up whole numbers by entry (parts x 256 rows a task), and the sums give the next codebook,
of bounded size on the driver. Nothing is grouped by vector or by label before it is added up, so copies of a vector or a
label that a third of all rows have weigh no more than others.

Rows whose vector is null or holds a null, a NaN or an infinity go. Codebooks start with the parts of the 256 smallest
ids; rows of equal id are taken in order of their vectors, null ids come last. Fewer rows make smaller codebooks. Null
labels are a label. Rows that repeat are coded like others. All vectors must have the length of the first one, a
multiple of the number of parts, and components below 2^17; else the query stops. An empty table gives an empty result.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import prepare, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Whole numbers that components stay below, so that squared distances fit 64 bits.
LIMIT = 1 << 27
#: Vectors screened together, and pairs worked out again together.
SCREEN_ROWS, EXACT_PAIRS = 4096, 1 << 16


def kept(table: DataFrame) -> DataFrame:
    """vec_id, label, x (whole numbers) of the rows with a usable vector."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE))
    return table.filter(F.col("embedding").isNotNull() & fine).select("vec_id", "label", F.transform(x, lambda v: F.when(F.abs(v) < LIMIT, v).otherwise(F.raise_error(F.lit(f"a component is not below {LIMIT // SCALE}"))).cast("int")).alias("x"))


def matrix(column, width: int):
    """Whole-number vectors of an Arrow list column as an int64 matrix."""
    import numpy as np

    if any(n != width for n in column.value_lengths().unique().to_pylist()):
        raise ValueError(f"vectors have {width} components or other numbers of them")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


class Nearest:
    """Exact nearest entries of an int64 codebook."""

    def __init__(self, book):
        import numpy as np

        self.book = book
        self.at = np.sort(np.unique(book, axis=0, return_index=True)[1])  # of equal entries the first
        self.c = book[self.at]
        self.c32 = self.c.astype(np.float32).T.copy()
        self.norm2 = (self.c * self.c).sum(1)
        d, u = book.shape[1], 2.0**-24
        self.gamma = (d + 2) * u / (1 - (d + 2) * u)

    def __call__(self, x):
        """Number of the nearest entry, and its squared distance, for every row of an int64 matrix."""
        import numpy as np

        numbers, errors = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        for i in range(0, len(x), SCREEN_ROWS):
            rows = x[i : i + SCREEN_ROWS]
            low, high = self.intervals(rows)
            row, entry = np.nonzero(low <= high.min(1, keepdims=True))
            exact = np.empty(len(row), np.int64)
            for j in range(0, len(row), EXACT_PAIRS):
                away = rows[row[j : j + EXACT_PAIRS]] - self.c[entry[j : j + EXACT_PAIRS]]
                exact[j : j + EXACT_PAIRS] = (away * away).sum(1)
            first = np.lexsort((entry, exact, row))[np.searchsorted(row, np.arange(len(rows)))]
            numbers[i : i + len(rows)], errors[i : i + len(rows)] = self.at[entry[first]], exact[first]
        return numbers, errors

    def intervals(self, rows):
        """Ends between which |c|^2 - 2 x.c lies, by row and entry; |x|^2 is the same for all of a row's."""
        import numpy as np

        product = (rows.astype(np.float32) @ self.c32).astype(np.float64)
        length = np.sqrt((rows * rows).sum(1).astype(np.float64))[:, None] * np.sqrt(self.norm2.astype(np.float64))[None, :]
        middle = self.norm2.astype(np.float64)[None, :] - 2 * product
        # the product's error, then that of these double operations
        slack = 2 * self.gamma * length * (1 + 2.0**-40) + 2.0**-48 * (self.norm2.astype(np.float64)[None, :] + 2 * np.abs(product)) + 2.0**-20
        return middle - slack, middle + slack


def _assigned(b, books):
    x = matrix(b.column("x"), sum(c.shape[1] for c in books))
    d = books[0].shape[1]
    return x, [Nearest(c)(x[:, p * d : (p + 1) * d]) for p, c in enumerate(books)]


def _sums(books):
    """Rows and sums of the parts of every entry that a task's vectors use."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        d = books[0].shape[1]
        sums = np.zeros((len(books), ENTRIES, d), np.int64)
        counts = np.zeros((len(books), ENTRIES), np.int64)
        for b in batches:
            x, found = _assigned(b, books)
            for p, (numbers, _) in enumerate(found):
                order = np.argsort(numbers, kind="stable")
                used, starts = np.unique(numbers[order], return_index=True)
                sums[p, used] += np.add.reduceat(x[order, p * d : (p + 1) * d], starts, axis=0) if len(x) else 0
                counts[p] += np.bincount(numbers, minlength=ENTRIES)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": pa.array(counts[part, entry]), "sums": pa.array(list(sums[part, entry]), pa.list_(pa.int64()))})

    return run


def _codes(books):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            _, found = _assigned(b, books)
            code = ["".join(f"{n:02x}" for n in row) for row in zip(*(numbers.tolist() for numbers, _ in found))]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(code, pa.string()), pa.array(sum(errors for _, errors in found), pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def trained(rows: DataFrame, parts: int = PARTS, rounds: int = ROUNDS) -> list:
    """The codebooks (an int64 matrix for each part) of rows (vec_id, x); none where there are no rows."""
    import numpy as np

    first = rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).collect()
    if not first:
        return []
    width = len(first[0].x)
    if width % parts or any(len(r.x) != width for r in first):
        raise ValueError(f"vectors of {width} components can't be cut into {parts} parts, or lengths differ")
    d = width // parts
    books = [np.array([r.x[p * d : (p + 1) * d] for r in first], np.int64).reshape(len(first), d) for p in range(parts)]
    for _ in range(rounds):
        local = rows.select("x").mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
        total = local.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(d))).alias("sums"))
        books = [c.copy() for c in books]
        for r in total.collect():  # parts x ENTRIES rows at most
            books[r.part][r.entry] = np.array(r.sums, np.int64) // r.n
    return books


def coded(table: DataFrame, parts: int = PARTS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 and label of every row with a usable vector."""
    prepare(table.sparkSession)
    rows = staged(kept(table), "vectors")
    books = trained(rows, parts, rounds)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    if not books:
        return rows.selectExpr("vec_id", "'' as code", "0L as error", "0L as label_error", "'' as codebooks_sha256", "label").limit(0)
    final = hashlib.sha256(",".join(str(v) for c in books for v in c.ravel().tolist()).encode()).hexdigest()
    codes = staged(rows.mapInArrow(_codes(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes")
    by_label = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("__label"))).select("vec_id", "code", "error", "label_error", F.lit(final).alias("codebooks_sha256"), "label")


def decoded(codes: DataFrame, books: list) -> DataFrame:
    """Codes back to vectors: each component the middle of its entry's whole number; books as `trained` gives them."""
    entries = [F.array(*(F.array(*(F.lit((v + 0.5) / SCALE) for v in row)) for row in c.tolist())) for c in books]
    number = [F.conv(F.substr("code", F.lit(2 * p + 1), F.lit(2)), 16, 10).cast("int") for p in range(len(books))]
    return codes.withColumn("vector", F.flatten(F.array(*map(F.get, entries, number))))
