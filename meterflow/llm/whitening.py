"""Whitening of embeddings along the leading eigenvectors of their covariance, by spectrum slicing.

Entries become whole numbers, so sums over all vectors are exact in any order: a first pass sums
each dimension, a second one the products of entries that are centred on the whole number nearest to
their mean; the rest of the mean, less than one, is taken out with exact fractions. The covariance
is therefore rounded once per entry.

Its leading eigenvalues are found from the top. The signs of the pivots of an LDLᵀ factorisation of
the covariance less a shift tell how many eigenvalues lie above the shift, so halving intervals
isolates each one with its number. From there inverse iteration and then Rayleigh quotient
iteration, which converges cubically, give value and vector; a value that leaves its interval sends
the search back to halve it once more. Counts just below and just above every value certify that it
has the number it is given. Eigenvalues that cannot be told apart in double precision share an
interval; their vectors are kept orthogonal to each other.

Only sums by dimension and pair of dimensions reach the driver, which are as many at any number of
rows; values, vectors and means go to the tasks with the function. A third pass measures the
covariance of the whitened values, a fourth gives the result.

Defined cases: a vector that is null, or holds a null, an entry that is not finite, or one of
2^42 or more (whose whole number would not leave room for exact products), is left out; so is a
vector whose length is not that of most (of equally many, the longer). A null id is an id like any
other, repeated rows count and come out each, and other columns may have any name. Components
without variance to double precision do not come out, so a table of equal vectors gives no rows,
nor does an empty one. ``deviation`` is null where it exceeds a long.
"""

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 42)
EPS = np.finfo(float).eps
# Sums of whole numbers below it are exact in doubles; products stay below it in 64 bits.
EXACT, ROOM = 1 << 53, 1 << 62


# -- whole vectors in tasks


def usable(rows, vector):
    """The vectors that count: no null and only finite entries."""
    fits = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(LARGEST)))
    return rows.filter(fits)


def whole_vectors(column):
    """{length: (places, whole numbers as rows)} of an Arrow column of lists."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    starts = column.offsets.to_numpy()[:-1] if len(column) else np.zeros(0, int)
    entries = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    found = {}
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        block = entries[starts[places][:, None] + np.arange(size)]
        found[int(size)] = places, np.floor(SCALE * block).astype(np.int64) + SHIFT
    return found


def _products(rows):
    """Exact sums of products of the columns of whole numbers."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < EXACT:
        plain = rows.astype(np.float64)
        return (plain.T @ plain).astype(np.int64)
    return rows.astype(object).T @ rows.astype(object)


def _decimals(values):
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38))


def sums(rows, vector):
    """(length, number of vectors, exact sums by dimension) of the vectors of the commonest
    length, None if there is none."""
    def add(batches):
        totals = {}
        for batch in batches:
            for size, (places, whole) in whole_vectors(batch.column(0)).items():
                n, total = totals.get(size, (0, 0))
                totals[size] = n + len(places), total + whole.sum(axis=0).astype(object)
        lines = [(size, dim, n, total) for size, (n, each) in totals.items()
                 for dim, total in enumerate(each)]
        size, dim, n, total = zip(*lines) if lines else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(size, pa.int32()), pa.array(dim, pa.int32()), pa.array(n, pa.int64()),
             _decimals(total)], names=["size", "dim", "n", "total"])

    parts = rows.select(vector).mapInArrow(add, "size int, dim int, n long, total decimal(38,0)")
    found = {}
    for row in parts.groupBy("size", "dim").agg(F.sum("n"), F.sum("total")).collect():
        found.setdefault(row[0], {})[row[1]] = row[2], int(row[3])
    if not found:
        return None
    size = max(found, key=lambda size: (found[size][0][0], size))
    return size, found[size][0][0], [found[size][dim][1] for dim in range(size)]


def covariance(rows, vector, size, n, totals):
    """(the covariance, its trace, the centre): products are centred on the nearest whole number
    to each mean and summed exactly; what is left of the mean goes as an exact fraction."""
    centre = [(2 * total + n) // (2 * n) for total in totals]
    about = np.array(centre, np.int64)

    def add(batches):
        total = np.zeros((size, size), object)
        for batch in batches:
            for length, (_, whole) in whole_vectors(batch.column(0)).items():
                if length == size:
                    total = total + _products(whole - about)
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(total[i, j])],
            names=["i", "j", "total"])

    parts = rows.select(vector).mapInArrow(add, "i int, j int, total decimal(38,0)")
    matrix, trace = np.zeros((size, size)), 0
    rest = [total - n * c for total, c in zip(totals, centre)]
    for i, j, total in parts.groupBy("i", "j").agg(F.sum("total")).collect():
        numerator = n * int(total) - rest[i] * rest[j]
        matrix[i, j] = matrix[j, i] = numerator / (n * n)
        trace += numerator if i == j else 0
    return matrix, trace / (n * n), about


# -- the spectrum, on the driver


def above(matrix, shift):
    """How many eigenvalues exceed the shift: the positive pivots of an LDLᵀ factorisation of the
    matrix less the shift, with pivots of one or two rows from the largest entries left."""
    rest = matrix - shift * np.eye(len(matrix))
    bound, count = (1 + 17 ** 0.5) / 8, 0
    noise = EPS / 64 * np.abs(rest).max(initial=0)  # less is left of rounding alone
    while len(rest):
        diagonal = np.abs(np.diagonal(rest))
        r = int(diagonal.argmax())
        off = np.abs(rest)
        np.fill_diagonal(off, 0)
        p, q = divmod(int(off.argmax()), len(rest))
        if max(diagonal[r], off[p, q]) <= noise:
            return count
        if diagonal[r] >= bound * off[p, q]:
            chosen = [r]
            count += rest[r, r] > 0
        else:  # such a pair has one eigenvalue of each sign
            chosen = [p, q]
            count += 1
        kept = np.delete(np.arange(len(rest)), chosen)
        side = rest[np.ix_(kept, chosen)]
        rest = rest[np.ix_(kept, kept)] - side @ np.linalg.solve(
            rest[np.ix_(chosen, chosen)], side.T)
        rest = (rest + rest.T) / 2
    return int(count)


def _solve(matrix, shift, vector, scale):
    """The unit vector along the solution of (matrix - shift) x = vector."""
    for nudge in (0.0, 1.0, -2.0, 8.0):
        try:
            found = np.linalg.solve(
                matrix - (shift + nudge * EPS * scale) * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:
            continue
        length = np.linalg.norm(found)
        if np.isfinite(length) and length:
            return found / length
    raise ArithmeticError(f"no solution at the shift {shift}")


def _apart(vector, others):
    """The unit vector along the part of a vector that is orthogonal to others."""
    for _ in range(2):
        for other in others:
            vector = vector - (other @ vector) * other
    return vector / np.linalg.norm(vector)


def leading(matrix, most=COMPONENTS):
    """(values, vectors as columns) of the leading eigenvalues with variance, at most ``most``."""
    size = len(matrix)
    largest = float(np.abs(matrix).max(initial=0.0))
    if not largest:
        return np.zeros(0), np.zeros((size, 0))
    unit = 2.0 ** np.floor(np.log2(largest))  # a power of two, so that nothing is rounded
    values, vectors = _leading(matrix / unit, most)
    return values * unit, vectors


def _leading(matrix, most):
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue exceeds it
    finest, least = 4 * EPS * scale, size * EPS * scale
    known = {2 * scale: 0, -2 * scale: size}  # shift: eigenvalues above it
    draw = np.random.default_rng(0)
    values, vectors = [], []

    def halve(low, high):
        known[(low + high) / 2] = above(matrix, (low + high) / 2)

    def interval(number):
        """The narrowest known one around the eigenvalue of that number."""
        low = max(shift for shift, count in known.items() if count >= number)
        return low, min(s for s, count in known.items() if count < number and s > low)

    def converge(low, high, beside):
        shift = (low + high) / 2
        vector = _apart(draw.standard_normal(size), beside)
        for _ in range(3):
            vector = _apart(_solve(matrix, shift, vector, scale), beside)
        for _ in range(12):
            value = float(vector @ matrix @ vector)
            if np.linalg.norm(matrix @ vector - value * vector) <= finest:
                break
            vector = _apart(_solve(matrix, value, vector, scale), beside)
        return float(vector @ matrix @ vector), vector

    for number in range(1, min(most, size) + 1):
        while True:
            low, high = interval(number)
            if high <= least:
                return np.array(values), np.array(vectors).reshape(-1, size).T
            alone = known[low] == number and known[high] == number - 1
            if not alone and high - low > finest:
                halve(low, high)
                continue
            # Values that share the finest interval keep their vectors apart.
            beside = [v for value, v in zip(values, vectors) if value <= high + finest]
            value, vector = converge(low, high, beside)
            error = np.linalg.norm(matrix @ vector - value * vector)
            if (low - finest < value < high + finest and error <= 16 * finest) or (
                    high - low <= finest):
                break
            halve(low, high)
        if value <= least:
            break
        margin = size ** 0.5 * finest
        if above(matrix, value - margin) < number or above(matrix, value + margin) >= number:
            raise ArithmeticError(f"{value} is not eigenvalue number {number}")
        values.append(value)
        vectors.append(_apart(vector, vectors))
    return np.array(values), np.array(vectors).reshape(-1, size).T


# -- whitened values


def _centred(whole, about, n, rest):
    """n x - S of whole vectors, exactly."""
    off = whole - about
    most = int(np.abs(off).max(initial=0)) + 1
    if most * n >= ROOM:
        off = off.astype(object)
    return n * off - rest


def _deviations(centred):
    """Exact sums of squares, None beyond a long."""
    most = int(np.abs(centred).max(initial=0))
    if most * most * centred.shape[1] < ROOM:
        return (centred * centred).sum(axis=1).tolist()
    exact = (centred.astype(object) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def whiten(rows, vec_id="vec_id", vector="embedding", most=COMPONENTS):
    """One row per usable vector and component: ``vec_id``, ``component`` from 1 by falling
    eigenvalue, ``n`` vectors in all, the exact ``deviation`` of the vector, its ``whitened``
    coordinate, the share of variance ``explained``, and ``identity_error``, the largest entry of
    the whitened covariance less the identity."""
    rows = usable(rows.select(vec_id, vector), vector)
    kind = rows.schema[vec_id].dataType.simpleString()
    found = sums(rows, vector)
    size, n, totals = found or (0, 0, [])
    if found:
        matrix, trace, about = covariance(rows, vector, size, n, totals)
        values, vectors = leading(matrix, most)
    else:
        values, vectors, about, trace = np.zeros(0), np.zeros((0, 0)), np.zeros(0, np.int64), 1.0
    rest = np.array([total - n * int(c) for total, c in zip(totals, about)], object)
    if all(abs(r) < ROOM for r in rest):
        rest = rest.astype(np.int64)
    components, project = len(values), vectors / np.sqrt(values)

    def white(whole):
        centred = _centred(whole, about, n, rest)
        return centred, (centred.astype(np.float64) / n) @ project

    def spread(batches):
        total, each = np.zeros((components, components)), np.zeros(components)
        for batch in batches:
            for length, (_, whole) in whole_vectors(batch.column(0)).items():
                if length == size:
                    coordinates = white(whole)[1]
                    total, each = total + coordinates.T @ coordinates, each + coordinates.sum(0)
        i, j = np.indices((components, components + 1)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
             pa.array(np.column_stack([total, each]).reshape(-1))], names=["i", "j", "total"])

    error = 0.0
    if components:
        parts = rows.select(vector).mapInArrow(spread, "i int, j int, total double")
        whitened = np.zeros((components, components + 1))
        for i, j, total in parts.groupBy("i", "j").agg(F.sum("total")).collect():
            whitened[i, j] = total / n
        means = whitened[:, -1]
        error = float(np.abs(
            whitened[:, :-1] - np.outer(means, means) - np.eye(components)).max())
    explained = values / trace

    def give(batches):
        for batch in batches:
            for length, (places, whole) in whole_vectors(batch.column(1)).items():
                if length != size or not components:
                    continue
                centred, coordinates = white(whole)
                at = np.repeat(np.arange(len(places)), components)
                ids = batch.column(0).take(pa.array(places[at]))
                count = len(at)
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, components + 1), len(places)), pa.int32()),
                    pa.array(np.full(count, n), pa.int64()),
                    pa.array(_deviations(centred), pa.int64()).take(pa.array(at)),
                    pa.array(coordinates.reshape(-1)),
                    pa.array(np.tile(explained, len(places))),
                    pa.array(np.full(count, error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                          "identity_error"])

    return rows.mapInArrow(
        give, f"vec_id {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
