import heapq
import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest

from meterflow.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, repaired rows) by a search through all edits, cheapest and least first;
    ``rows`` are (role, text, fault)."""
    heap = [(0, "", 0, (), 0)]
    while heap:
        cost, letters, at, out, inserted = heapq.heappop(heap)
        initials = "".join(role[:1] or "-" for role, _ in out)
        if at == len(rows) and LEGAL.fullmatch(initials):
            return cost, letters, list(out)
        if not re.match(r"s?(ua)*u?$", initials):
            continue
        if inserted < 2:
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 5, letters + "I", at, (*out, (role, "")), inserted + 1))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 2, letters + "D", at + 1, out, 0))
            if fault not in ("blank", "duplicate"):
                stays = cost + 5 * (fault == "truncated")
                heapq.heappush(heap, (stays, letters + "K", at + 1, (*out, (role, text)), 0))
                for other in ("user", "assistant"):
                    heapq.heappush(
                        heap, (stays + 1, letters + "R", at + 1, (*out, (other, text)), 0))


def plain(conversations):
    """The whole repair, row by row."""
    found, kept = {row[0]: [] for row in conversations}, []
    for conv, turn, role, text in conversations:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = zlib.crc32(name.encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        kept += [(conv, turn, role, text)] * (2 if case == 3 else 1)

    def place(row):
        key = sha256(f"{row[2]}\n{row[3]}".encode()).digest()[:16]
        return (row[1] is not None, row[1] or 0, row[2], key)

    for row in sorted(kept, key=place):
        found[row[0]].append(row)
    results = {}
    for conv, rows in found.items():
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in rows:
            solid = text.strip(" \t\n\v\f\r")
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
            counts[fault] = counts.get(fault, 0) + 1
            marked.append((role, text, fault))
        times = {t for _, t, _, _ in rows if t is not None}
        gaps = max(times) - min(times) + 1 - len(times) if times else 0
        pairs = [(a[0][:1] or "-") + b[0][:1] for a, b in zip(marked, marked[1:])]
        cost, audit, out = cheapest(marked)
        text = "\n".join(f"{role}:{text}" for role, text in out)
        results[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"],
                         sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                         sha256(text.encode()).hexdigest())
    return results


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256"]


def repaired(frame, **options):
    rows = turns.repair(frame, **options).select("conv_id", *COLUMNS).collect()
    found = {row[0]: tuple(row)[1:] for row in rows}
    assert len(found) == len(rows)
    return found


FAULT = {**dict.fromkeys(turns.SOUND), **dict.fromkeys(turns.TRUNCATED, "truncated"),
         **dict.fromkeys(turns.DUPLICATE, "duplicate"), **dict.fromkeys(turns.BLANK, "blank")}
ROLES = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}


def test_automaton_against_all_edits():
    automaton = turns.Automaton()
    marks = "suaoSUAO1"
    texts = ["".join(s) for n in range(5) for s in itertools.product(marks, repeat=n)]
    texts = random.Random(1).sample(texts, 1500) + [t for t in texts if len(t) < 3]
    made = 0
    for signature in sorted(texts, key=lambda t: t[::-1]):
        rows = [(ROLES[turns.INITIAL[m]], "x", FAULT[m]) for m in signature]
        entry = automaton.entries(signature, turns.LAST)[turns.START]
        assert (entry[0], turns.audit(entry)) == cheapest(rows)[:2], signature
        made += len(signature)
    assert automaton.made < made / 2  # ends are shared


def test_segments_against_the_whole():
    draw = random.Random(2)
    for _ in range(300):
        signature = "".join(draw.choices("suaoSUAO15", k=draw.randint(2, 9)))
        cuts = sorted(draw.sample(range(1, len(signature)), draw.randint(1, len(signature) - 1)))
        parts = [signature[a:b] for a, b in zip([0, *cuts], [*cuts, len(signature)])]
        automaton = turns.Automaton()
        ways = [turns.crossings(automaton, p, n == len(cuts)) for n, p in enumerate(parts)]
        cost, audit = 0, ""
        for part, (state, leaving) in zip(parts, turns.route(ways)):
            entry = automaton.entries(part, leaving)[state]
            cost, audit = cost + entry[0], audit + turns.audit(entry)
        whole = automaton.entries(signature, turns.LAST)[turns.START]
        assert (cost, audit) == (whole[0], turns.audit(whole)), parts


def random_rows(seed, convs=60):
    draw, rows = random.Random(seed), []
    for conv in range(convs):
        for turn in range(draw.randint(0, 7)):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = draw.choice(["Yes.", "No!", "Why?  ", "cut off", "", " \n", "Yes.", None,
                                f"Own {turn}.", "é."])
            rows.append((conv, draw.choice([turn, turn, turn, turn + 2, None]), role, text))
            if draw.random() < 0.1:
                rows.append(rows[-1])
    return rows + [(None, None, None, None), (None, 3, "user", "Hi."), (None, 3, "user", "Hi.")]


@pytest.mark.parametrize("segment", [turns.SEGMENT, 1, 3])
def test_same_as_row_by_row(spark, segment):
    from pyspark.sql import functions as F

    rows = random_rows(segment)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.select("*", *[F.lit("own").alias(c) for c in (
        "key", "symbol", "kind", "head", "number", "audit", "cost", "signature", "copies")])
    assert repaired(frame, segment=segment) == plain(rows)


def test_many_copies_of_one_row_and_a_long_text(spark):
    rows = [(1, 5, "user", "Same.")] * 500 + [(1, 6, "assistant", "Long. " * 50_000)]
    rows += [(2, t, "user", "Common.") for t in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    wanted = plain(rows[:20] + rows[500:501])
    found = repaired(frame, segment=64)
    assert found[1][2] == 499 + (zlib.crc32(b"1:5") % 20 == 3) * 500 and found[1][5] >= 2 * 499
    assert found[1][6].endswith(wanted[1][6][-1])
    assert found[2][2] > 200


def test_all_rows_dropped(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    found = repaired(spark.createDataFrame(gone, SCHEMA))
    assert set(found.values()) == {(0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}
    assert len(found) == len(gone)


def test_empty_table(spark):
    assert repaired(spark.createDataFrame([], SCHEMA)) == {}
