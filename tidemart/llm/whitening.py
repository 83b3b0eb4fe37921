"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Vectors are cut to whole numbers, so the scatter n * sum(x x') - S S' is a matrix of integers, n squared times the covariance. Tasks
add up its parts exactly. Its characteristic polynomial is found modulo many primes, one prime to a row, by reduction to Hessenberg
form, and each coefficient is put together by Chinese remaindering. All roots are real, so the sign changes of the polynomial shifted
to t are exactly the roots above t: bisection on that count isolates the largest roots to as many bits as wanted, equal ones
included. Inverse iteration in whole-number arithmetic then gives the null space of scatter minus root, hence the components.

What passes through the driver is the scatter, the polynomial and the components: sizes of the dimension, not of the data.
"""

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType

from tidemart.llm.text import DOUBLE, LONG, free_name, pick, struct
from tidemart.sources.scratch import materialise

SCALE = 256
COMPONENTS = 4
#: Bits of the whole-number parts that tasks send, of primes, of roots relative to their size, and of vectors while they are solved for.
LIMB, PRIME, ROOT, FINE = 40, 31, 100, 240


def whole(col: Column) -> Column:
    """Each entry c as floor(256 c)."""
    return F.transform(col, lambda c: F.floor(c.cast("double") * SCALE))


def usable(col: Column) -> Column:
    """Whether a vector has entries, and all of them are finite numbers."""
    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    return col.isNotNull() & (F.size(col) > 0) & ~F.exists(col, lambda c: F.coalesce(bad(c.cast("double")), F.lit(True)))


def _matrix(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def gram(x: np.ndarray) -> np.ndarray:
    """x' x in Python integers, exactly."""
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if largest == 0:
        return np.zeros((x.shape[1], x.shape[1]), object)
    rows = (1 << 53) // (largest * largest)  # so many products are added without rounding
    if rows < 1:
        x = x.astype(object)
        return x.T @ x
    parts = (x[i:i + rows].astype(np.float64) for i in range(0, len(x), rows))
    return sum(((p.T @ p).astype(np.int64).astype(object) for p in parts), np.zeros((x.shape[1],) * 2, object))


def _moments(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1), object)
        for batch in batches:
            x = _matrix(batch, "x", dim)
            total = total + gram(np.column_stack((np.ones(len(x), np.int64), x)))
        out = []
        for i in range(dim + 1):
            for j in range(i, dim + 1):
                value, limb = int(total[i, j]), 0
                sign, value = (-1 if value < 0 else 1), abs(value)
                while value:
                    out.append((i, j, limb, sign * (value & ((1 << LIMB) - 1))))
                    value, limb = value >> LIMB, limb + 1
        if out:
            i, j, limb, part = zip(*out)
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "limb": pa.array(limb, pa.int32()),
                "part": pa.array(part, pa.int64()),
            })

    return run


def scatter(fit: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S, and n * sum(x x') - S S' of the vectors in `x`, all exact."""
    parts = fit.mapInArrow(_moments(dim), "i int, j int, limb int, part long").groupBy("i", "j", "limb").agg(
        F.sum("part").alias("part")
    )
    found = [[0] * (dim + 1) for _ in range(dim + 1)]
    for row in parts.collect():  # a few numbers per pair of dimensions
        found[row["i"]][row["j"]] += row["part"] << (LIMB * row["limb"])
    n, sums = found[0][0], found[0][1:]
    matrix = [[0] * dim for _ in range(dim)]
    for i in range(dim):
        for j in range(i, dim):
            matrix[i][j] = matrix[j][i] = n * found[i + 1][j + 1] - sums[i] * sums[j]
    return n, sums, matrix


def is_prime(n: int) -> bool:
    """For odd n below 2 ** 31."""
    d, twos = n - 1, 0
    while d % 2 == 0:
        d, twos = d // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1) or base % n == 0:
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2 ** 31 whose product has more than `bits` bits."""
    out, held, n = [], 0.0, (1 << PRIME) + 1
    while held <= bits + 1:
        n -= 2
        if is_prime(n):
            out.append(n)
            held += math.log2(n)
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """The characteristic polynomial of a matrix of residues, lowest coefficient first, modulo p."""
    h, n = matrix.astype(np.int64) % p, len(matrix)
    for m in range(1, n - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        factors = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - factors[:, None] * h[m][None, :] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * factors[None, :] % p).sum(axis=1)) % p
    steps = [np.array([1], np.int64)]
    for k in range(n):
        new = np.zeros(k + 2, np.int64)
        new[1:] = steps[k]
        new[:k + 1] = (new[:k + 1] - h[k, k] * steps[k]) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            if not below:
                break
            new[:i + 1] = (new[:i + 1] - int(h[i, k]) * below % p * steps[i]) % p
        steps.append(new)
    return steps[n].tolist()


def _residues(matrix: list[list[int]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exact = np.array(matrix, dtype=object)
        for batch in batches:
            for p in batch["p"].tolist():
                found = polynomial_mod((exact % p).astype(np.int64), p)
                yield pd.DataFrame({"k": np.arange(len(found), dtype=np.int32), "p": p, "residue": found})

    return run


def _remaindered(group: pd.DataFrame) -> pd.DataFrame:
    """One coefficient from its residues, as text."""
    value, modulus = 0, 1
    for p, residue in sorted(zip(group["p"].tolist(), group["residue"].tolist())):
        value += modulus * ((residue - value) * pow(modulus, -1, p) % p)
        modulus *= p
    if value > modulus // 2:
        value -= modulus
    return pd.DataFrame({"k": [int(group["k"].iloc[0])], "value": [str(value)]})


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The characteristic polynomial of a symmetric matrix without negative roots, lowest coefficient first, exactly.

    Its coefficients together are at most the product of (1 + root), which the trace bounds.
    """
    dim = len(matrix)
    trace = sum(matrix[i][i] for i in range(dim))
    wanted = primes(2 + dim * (trace // dim + 2).bit_length())
    rows = spark.createDataFrame([(p,) for p in wanted], "p long").repartition(min(len(wanted), 16), "p")
    residues = rows.mapInPandas(_residues(matrix), "k int, p long, residue long")
    found = residues.groupBy("k").applyInPandas(_remaindered, "k int, value string").collect()
    return [int(r["value"]) for r in sorted(found, key=lambda r: r["k"])]


def roots_above(coefficients: list[int], a: int, bits: int) -> int:
    """How many roots lie above a / 2 ** bits, with their multiplicity; all roots must be real.

    The coefficients of the polynomial about that point have as many sign changes as it has positive roots there.
    """
    degree = len(coefficients) - 1
    c = [v << (bits * (degree - k)) for k, v in enumerate(coefficients)]
    for i in range(degree):
        for j in range(degree - 1, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def isolate(coefficients: list[int], place: int, most: int) -> tuple[int, int] | None:
    """The root of rank `place` from above as (a, bits), with a / 2 ** bits <= root < (a + 1) / 2 ** bits; None if it is not positive."""
    if roots_above(coefficients, 0, 0) < place:
        return None
    bits, low, high = 0, 0, most + 1
    while high - low > 1:
        middle = (low + high) // 2
        if roots_above(coefficients, middle, 0) >= place:
            low = middle
        else:
            high = middle
    while low.bit_length() < ROOT:  # roots above low, not above low + 1
        bits, low = bits + 1, 2 * low
        if roots_above(coefficients, low + 1, bits) >= place:
            low += 1
    return low, bits


def null_space(matrix: list[list[int]], root: tuple[int, int], count: int) -> list[list[float]]:
    """`count` unit vectors, orthogonal to each other, that the matrix only stretches by `root`.

    Inverse iteration in numbers with `FINE` bits behind the point: elimination with pivoting, then back substitution from as many
    unlike starts, made orthogonal each time.
    """
    dim, (a, bits) = len(matrix), root
    lu = np.array([[v << FINE for v in row] for row in matrix], dtype=object)
    shift = ((2 * a + 1) << FINE) >> (bits + 1)
    for i in range(dim):
        lu[i, i] -= shift
    order = list(range(dim))
    for k in range(dim):
        best = max(range(k, dim), key=lambda i: abs(lu[i, k]))
        if best != k:
            lu[[k, best]] = lu[[best, k]]
            order[k], order[best] = order[best], order[k]
        if lu[k, k] == 0:
            lu[k, k] = 1
        for i in range(k + 1, dim):
            if lu[i, k]:
                factor = (lu[i, k] << FINE) // lu[k, k]
                lu[i, k] = factor
                lu[i, k + 1:] -= (factor * lu[k, k + 1:]) >> FINE
    found = [np.array([(1 << FINE) // (1 + (i * (2 * s + 3) + s * s) % (dim + 1)) for i in range(dim)], dtype=object) for s in range(count)]
    for _ in range(4):
        new: list[np.ndarray] = []
        for b in found:
            x = b[order]
            for k in range(dim):
                x[k] -= sum((lu[k, :k] * x[:k]).tolist()) >> FINE
            for k in range(dim - 1, -1, -1):
                x[k] = ((x[k] << FINE) - sum((lu[k, k + 1:] * x[k + 1:]).tolist())) // lu[k, k]
            for _ in range(2):
                x = _unit(x)
                for y in new:
                    x = x - ((sum((x * y).tolist()) * y) >> (2 * FINE))
            new.append(_unit(x))
        found = new
    return [_signed([v / (1 << FINE) for v in x.tolist()]) for x in found]


def _unit(x: np.ndarray) -> np.ndarray:
    norm = math.isqrt(sum((x * x).tolist()))
    return np.array([(v << FINE) // max(norm, 1) for v in x.tolist()], dtype=object)


def _signed(x: list[float]) -> list[float]:
    """The sign that makes the first of the largest entries positive."""
    return x if max(x, key=abs) > 0 else [-v for v in x]


def components(
    spark: SparkSession, matrix: list[list[int]], count: int = COMPONENTS
) -> list[tuple[Fraction, list[float]]]:
    """The largest positive roots of a scatter and their unit vectors, falling. Roots and vectors are found in tasks."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if trace == 0:
        return []
    coefficients = polynomial(spark, matrix)
    places = spark.createDataFrame([(i,) for i in range(1, min(count, len(matrix)) + 1)], "place int").repartition(count, "place")

    def roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place in batch["place"].tolist():
                if (root := isolate(coefficients, place, trace)) is not None:
                    yield pd.DataFrame({"place": [place], "a": [str(root[0])], "bits": [root[1]]})

    found = {r["place"]: (int(r["a"]), r["bits"]) for r in places.mapInPandas(roots, "place int, a string, bits int").collect()}
    groups: list[tuple[tuple[int, int], int]] = []  # equal roots share a null space
    for place in sorted(found):
        if groups and groups[-1][0] == found[place]:
            groups[-1] = (found[place], groups[-1][1] + 1)
        else:
            groups.append((found[place], 1))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g in batch["g"].tolist():
                yield pd.DataFrame({"g": g, "v": null_space(matrix, *groups[g])})

    rows = spark.createDataFrame([(g,) for g in range(len(groups))], "g int").repartition(count, "g")
    solved: dict[int, list[list[float]]] = {}
    for row in rows.mapInPandas(vectors, "g int, v array<double>").collect():
        solved.setdefault(row["g"], []).append(row["v"])
    return [(Fraction(a, 1 << bits), v) for g, ((a, bits), _) in enumerate(groups) for v in solved.get(g, [])]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S: in 64 bits where they hold it and its square, else in Python integers."""
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
    most = n * largest + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _projected(x: np.ndarray, sums: list[int], n: int, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    y = _centred(x, n, sums)
    return y, y.astype(np.float64) @ axes


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS
) -> DataFrame:
    """A row per usable row of `df` and component up to `count`: the id, `component`, `n`, `deviation`, `whitened`, `explained`,
    `identity_error`.

    Rows whose vector is NULL, empty or holds NULL, NaN or infinite entries are left out, and so are vectors of another length
    than most rows have (of equally common lengths the greater counts). The components are those of the covariance of the distinct
    whole-number vectors, so copies do not weigh; every copy gets its rows. Components without variance cannot be whitened and
    are left out: with one distinct vector, or none, there are no rows. Of equal roots any orthogonal vectors serve; they are the same
    for all rows and runs. `deviation` is NULL where 64 bits do not hold it. NULL ids are kept. Other columns are left out.
    """
    spark = df.sparkSession
    rows = pick(df, id_col, vector_col)
    vector = F.col(f"`{vector_col}`")
    rows = rows.where(usable(vector)).select(F.col(f"`{id_col}`").alias("id"), whole(vector).alias("x"))
    schema = struct(**{
        id_col: rows.schema["id"].dataType, "component": IntegerType(), "n": LONG, "deviation": LONG, "whitened": DOUBLE,
        "explained": DOUBLE, "identity_error": DOUBLE,
    })
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    common = sizes.agg(F.max(F.struct("rows", "size"))).first()[0]
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common["size"]
    rows = rows.where(F.size("x") == dim)
    fit = materialise(rows.select("x").distinct(), "fit")
    n, sums, matrix = scatter(fit, dim)
    found = components(spark, matrix, count)
    if not found:
        return spark.createDataFrame([], schema)
    trace = sum(matrix[i][i] for i in range(dim))
    axes = np.array([v for _, v in found]).T / np.array([math.sqrt(root) for root, _ in found])
    explained = [float(root / trace) for root, _ in found]
    kept = len(found)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kept + 1, kept + 1))
        for batch in batches:
            w = _projected(_matrix(batch, "x", dim), sums, n, axes)[1]
            w = np.column_stack((np.ones(len(w)), w))
            total += w.T @ w
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    parts = fit.mapInArrow(products, "part array<double>").select(F.posexplode("part").alias("at", "value"))
    total = {r["at"]: r["value"] for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect()}
    moments = np.array([total[i] for i in range((kept + 1) ** 2)]).reshape(kept + 1, kept + 1) / n
    covariance = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    error = float(np.abs(covariance - np.eye(kept)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, w = _projected(_matrix(batch, "x", dim), sums, n, axes)
            deviation = [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]
            rows_of = np.repeat(np.arange(len(y)), kept)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(rows_of)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(y))),
                pa.array(np.full(len(rows_of), n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(rows_of)),
                pa.array(w.ravel()), pa.array(np.tile(explained, len(y))), pa.array(np.full(len(rows_of), error)),
            ], names=schema.names)

    return rows.mapInArrow(project, schema)
