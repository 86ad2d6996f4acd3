import numpy as np
from xxhash import xxh64_intdigest

from meterflow.llm import simhash

from .conftest import AWKWARD


def brute_print(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    hashes = [xxh64_intdigest(b" ".join(words[i:i + size]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_roots(prints, radius=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_groups(make_docs, awkward):
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        words = [f"{w}x{i // 4}" for w in base]
        words[i % 4 * 50] = "changed"
        rows.append((i * 3 + 1, " ".join(words)))
    rows += [(-5, ""), (-6, None), (500, "a b"), (501, "A  B"), (502, "a b c")]
    found = {r.doc_id: r for r in simhash.near_groups(make_docs(rows)).collect()}
    prints = [brute_print(text) for _, text in rows]
    roots = brute_roots(prints)
    for (doc_id, _), value, root in zip(rows, prints, roots):
        members = [rows[i][0] for i, r in enumerate(roots) if r == root]
        assert found[doc_id].fingerprint == f"{value:016x}"
        assert found[doc_id].component_id == min(members)
    assert simhash.near_groups(awkward).count() == len(AWKWARD)


def near_numbers(n, seed):
    random = np.random.default_rng(seed)
    base = random.integers(0, 2**63, n // 5 + 1, dtype=np.uint64)
    prints = base[random.integers(0, len(base), n)].copy()
    for i in range(n):
        for bit in random.choice(64, random.integers(0, 4), replace=False):
            prints[i] ^= np.uint64(1 << int(bit))
    return sorted(set(prints.view(np.int64).tolist()))


def test_links_connect_what_pairs_connect_also_in_split_keys(spark):
    prints = near_numbers(300, 3)
    close = [v ^ (1 << b) for v in prints[:1] for b in range(40)]
    prints = sorted(set(prints + close))
    wanted = brute_roots([p & (2**64 - 1) for p in prints])
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    for most in (8, 100_000):
        links = simhash.near_links(frame, most=most).collect()
        root = {p: p for p in prints}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for link in links:
            a, b = find(link.a), find(link.b)
            root[max(a, b)] = min(a, b)
        assert [find(p) for p in prints] == [prints[r] for r in wanted]


def test_bit_sliced_distances():
    random = np.random.default_rng(1)
    prints = random.integers(0, 2**63, 130, dtype=np.uint64)
    prints[70:] = prints[:60] ^ np.uint64(0b1111)
    planes = simhash.bit_planes(prints)
    for radius in (0, 3, 4, 9):
        places, lanes = simhash.near_lanes(
            planes, prints, np.zeros(130, np.int64), np.full(130, simhash.FULL), radius
        )
        found = {(p, b) for p, lane in zip(places, lanes) for b in range(64) if int(lane) >> b & 1}
        wanted = {(i, j) for i in range(130) for j in range(64)
                  if bin(int(prints[i] ^ prints[j])).count("1") <= radius}
        assert found == wanted


def test_links_of_a_dense_group_are_few():
    prints = np.sort(np.array([1 << i for i in range(60)], np.uint64))
    labels = simhash.local_groups(prints, np.full(60, 60))
    assert (labels == 0).all()


def test_drop_near_copies(make_docs, awkward, empty):
    kept = simhash.drop_near_copies(awkward)
    assert kept.dtypes == awkward.dtypes
    groups = simhash.near_groups(awkward).select("component_id").distinct().count()
    assert kept.count() == groups
    assert simhash.near_groups(empty).count() == 0 and simhash.drop_near_copies(empty).count() == 0
