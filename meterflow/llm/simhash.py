"""SimHash near-dedup with bit-sliced comparison.

A text's fingerprint has 64 bits, each the majority of that bit over the XXH64 of its shingles.
Texts link at ``radius`` or fewer differing bits, and a group is what links reach.

Equal fingerprints are first merged, so copies cost one row per map task. The bits are dealt
into ``radius + 2`` parts; two fingerprints within the radius agree in two parts at least, so
those that share a choice of two parts are compared. Rows are sorted by such a key, and a task
stores the bits of its rows vertically, 64 fingerprints to a word and a word for each of the 64
bits. A row is compared with 64 others at once: the differing bits are added into bit counters,
and a word is left alone once all of its fingerprints are beyond the radius. A task emits links
to the first row of each local group, at most one per row, never all pairs.

A key with more than ``most`` fingerprints is dealt into slots; each pair of slots is a unit of
its own, so a hot key is compared whole, by many tasks.

Defined cases: a null or blank text has fingerprint zero and links like any other. With fewer
words than a shingle has, the whole sequence is the one shingle. A null ``doc_id`` comes after
all others. Repeated rows are in one group. An empty table gives no rows. Further columns may
have any name.
"""

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from meterflow.llm.common import plain_words, small_batches
from meterflow.llm.components import components
from meterflow.session import written

WORDS = 4
RADIUS = 4
BITS = 64
MOST = 2048
SEED = 42
UNIT = ["choice", "part", "one", "two"]
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
NUMBER_ROWS = 20_000


def shingle_hashes(text, size=WORDS):
    """XXH64 of every run of ``size`` words, repeats included."""
    from xxhash import xxh64_intdigest

    words = plain_words(text)
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[min(size, len(words)) - 1:].tolist()
    return np.fromiter(
        (xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends)
    )


def fingerprint(text, size=WORDS, step=1 << 15):
    """The fingerprint as a signed number."""
    hashes = shingle_hashes(text, size)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), step):
        some = hashes[start:start + step]
        counts += np.unpackbits(
            some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        ).sum(0, dtype=np.int64)
    set_bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.int64)[0])


def fingerprint_column(text, size=WORDS):
    @F.pandas_udf(LongType())
    def column(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: fingerprint(text, size)).astype("int64")

    return column(text)


def hex_digits(number):
    return F.lower(F.lpad(F.hex(number), 16, "0"))


def part_masks(radius=RADIUS, spare=2):
    """Masks of every choice of ``spare`` parts, as signed numbers."""
    edges = [BITS * i // (radius + spare) for i in range(radius + spare + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(parts, spare)]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def _comparison_units(prints, radius, most):
    """Each fingerprint under every key, with the unit it is compared in."""
    choices = [
        F.struct(F.lit(i).cast("short").alias("choice"),
                 F.col("print").bitwiseAND(F.lit(mask)).alias("part"))
        for i, mask in enumerate(part_masks(radius))
    ]
    keys = prints.select("print", F.explode(F.array(*choices)).alias("key")).select(
        "print", "key.*"
    )
    hot = keys.groupBy("choice", "part").count().filter(F.col("count") > most)
    hot = written(
        hot.select("choice", "part", F.ceil(F.col("count") / (most // 2)).alias("slots")),
        "simhash-hot",
    )
    if hot.isEmpty():
        return keys.select("*", F.lit(0).alias("one"), F.lit(0).alias("two"))
    slots = F.coalesce("slots", F.lit(1))
    slot = F.pmod(F.xxhash64("print"), slots)
    dealt = keys.join(hot, ["choice", "part"], "left").select(
        "print", "choice", "part", slot.alias("slot"),
        F.explode(F.sequence(F.lit(0).cast("long"), slots - 1)).alias("other"),
    )
    return dealt.select(
        "print", "choice", "part", F.least("slot", "other").cast("int").alias("one"),
        F.greatest("slot", "other").cast("int").alias("two"),
    )


def bit_planes(prints):
    """[64, words]: bit i of every fingerprint, 64 of them to a word."""
    bits = np.unpackbits(
        prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    padded = np.zeros((BITS, -(-len(prints) // BITS) * BITS), np.uint8)
    padded[:, :len(prints)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def _beyond(counters, overflow, radius):
    """Lanes whose counter is above the radius."""
    above, equal = np.zeros_like(overflow), np.full_like(overflow, FULL)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            above |= equal & counters[i]
            equal &= ~counters[i]
    return above | overflow


def near_lanes(planes, values, words, valid, radius=RADIUS, every=8):
    """Compare ``values[i]`` with the 64 fingerprints of word ``words[i]``.

    Gives the places i with a near fingerprint among the ``valid`` lanes, and those lanes. Two
    bits at a time go through a carry-save step into the lowest counter; the carry goes up.
    """
    places = np.arange(len(values))
    counters = [np.zeros(len(values), np.uint64) for _ in range(max(1, radius.bit_length()))]
    overflow = np.zeros(len(values), np.uint64)

    def differing(bit):
        return planes[bit][words] ^ (np.uint64(0) - (values >> np.uint64(bit) & np.uint64(1)))

    for bit in range(0, BITS, 2):
        x, y, low = differing(bit), differing(bit + 1), counters[0]
        either = x ^ y
        carry = (x & y) | (either & low)
        counters[0] = either ^ low
        for i in range(1, len(counters)):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        overflow |= carry
        if bit % every == every - 2 or bit == BITS - 2:
            near = valid & ~_beyond(counters, overflow, radius)
            stay = near != 0
            if not stay.all():
                places, words, values = places[stay], words[stay], values[stay]
                valid, overflow, near = valid[stay], overflow[stay], near[stay]
                counters = [c[stay] for c in counters]
                if not len(places):
                    break
    return places, (near if len(places) else valid)


def merge_labels(labels, a, b):
    """Give all that a[i] and b[i] link the smallest label among them, in place."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels[:] = jumped


def local_groups(prints, ends, radius=RADIUS, step=1 << 13):
    """The first row that each row is linked with; row i is compared with i+1 to ends[i]-1."""
    labels = np.arange(len(prints))
    planes = bit_planes(prints)
    rows = np.flatnonzero(ends - labels > 1)
    first = (rows + 1) >> 6
    number = ((ends[rows] - 1) >> 6) - first + 1
    before = np.cumsum(number)
    start = 0
    while start < len(rows):
        done = before[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(before, done + step, "right")))
        some, many = rows[start:stop], number[start:stop]
        row = np.repeat(some, many)
        skipped = np.repeat(np.cumsum(many) - many, many)
        word = np.repeat(first[start:stop], many) + np.arange(len(row)) - skipped
        low = np.maximum(row + 1, word << 6) - (word << 6)
        high = np.minimum(ends[row], (word + 1) << 6) - (word << 6)
        valid = (FULL >> (64 - (high - low)).astype(np.uint64)) << low.astype(np.uint64)
        places, lanes = near_lanes(planes, prints[row], word, valid, radius)
        if len(places):
            bits = np.unpackbits(
                lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            at, lane = np.nonzero(bits)
            merge_labels(labels, row[places[at]], (word[places[at]] << 6) + lane)
        start = stop
    return labels


def unit_links(radius=RADIUS):
    """A function over sorted batches of units; a unit never spans more than it has to."""
    def compare(rows):
        units = [rows[c].to_numpy() for c in UNIT]
        new = np.ones(len(rows), bool)
        new[1:] = np.any([u[1:] != u[:-1] for u in units], axis=0)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(rows)))
        several = np.repeat(sizes > 1, sizes)
        sizes = sizes[sizes > 1]
        prints = rows["print"].to_numpy()[several].view(np.uint64)
        ends = np.repeat(np.cumsum(sizes), sizes)
        labels = local_groups(prints, ends, radius)
        linked = labels != np.arange(len(labels))
        signed = prints.view(np.int64)
        return pd.DataFrame({"a": signed[linked], "b": signed[labels[linked]]})

    def links(batches):
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = rows[UNIT].iloc[-1]
            same = (rows[UNIT] == last).all(axis=1).to_numpy()
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield compare(rows.iloc[:cut])
            held = rows.iloc[cut:]
        if held is not None and len(held):
            yield compare(held)

    return links


def near_links(prints, radius=RADIUS, most=MOST):
    """Links ``a``, ``b`` that connect just what pairs within the radius connect.

    ``prints`` holds each fingerprint once, in the column ``print`` of a stored table.
    """
    small_batches(prints.sparkSession, NUMBER_ROWS)
    units = _comparison_units(prints, radius, most)
    order = [*UNIT, "print"]
    dealt = units.repartition(*UNIT).sortWithinPartitions(*order)
    return dealt.mapInPandas(unit_links(radius), "a long, b long")


def _grouped(rows, radius, most):
    """``rows`` (number, doc_id, print) with ``best``, the first row of their group."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "number")
    prints = written(rows.groupBy("print").agg(F.min(order).alias("best")), "simhash-prints")
    roots = components(near_links(prints.select("print"), radius, most))
    rooted = prints.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", F.coalesce("root", "print").alias("root"), "best"
    )
    groups = rooted.groupBy("root").agg(F.min("best").alias("best"))
    chosen = written(
        rooted.drop("best").join(groups, "root").select("print", "best"), "simhash-groups"
    )
    return rows.join(chosen, "print")


def near_groups(docs, size=WORDS, radius=RADIUS, most=MOST):
    """One row per document: ``doc_id``, ``fingerprint``, ``component_id``."""
    small_batches(docs.sparkSession)
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("number"), "doc_id",
            fingerprint_column(F.col("text"), size).alias("print"),
        ), "simhash-rows",
    )
    return _grouped(rows, radius, most).select(
        "doc_id", hex_digits(F.col("print")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
    )


def drop_near_copies(docs, size=WORDS, radius=RADIUS, most=MOST):
    """The row with the smallest ``doc_id`` of each group, with every column of ``docs``."""
    small_batches(docs.sparkSession)
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("number"), F.struct("*").alias("row"),
            fingerprint_column(F.col("text"), size).alias("print"),
        ), "simhash-rows",
    )
    prints = rows.select("number", "row.doc_id", "print")
    dropped = _grouped(prints, radius, most).filter(F.col("best.number") != F.col("number"))
    dropped = written(dropped.select("number"), "simhash-dropped")
    return rows.join(dropped, "number", "left_anti").select("row.*")
