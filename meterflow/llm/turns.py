"""Conversation structure repair over a suffix-shared automaton of signatures.

A conversation's turns become a signature, a symbol per row for the role's initial and the fault.
Signatures are sorted from their ends, so that those with a common end stand together, and an
automaton is grown along them from the end: a node is one distinct rest of a signature, and holds
for each state of the role grammar the least cost to go, with the edit that begins the best rest of
the audit and a link to the entry that goes on. What two neighbours in the order share is computed
once; a task holds only the nodes of the signature at hand, however many there are. Equal
signatures share all their nodes, and tasks meet only at the borders of the range they sort.

Edits before and at a row are some inserts, then one letter for the row itself, so no row's edits
begin those of another choice, and the letters of one row alone decide between equal costs: the
first letters in ASCII order begin the least audit, and the rest of it follows from the state.

A conversation of very many rows is cut into segments. The rows are sorted over all tasks by
conversation and place, never gathered by conversation. For every segment of a cut conversation the
automaton gives the cost from each state to each other one, and a small table of these, sixteen
numbers for ``SEGMENT`` rows, says where each segment begins and ends; then it is solved like a
whole one. The last step runs through the rows of a conversation in order, with its audits between
them, and hashes the repaired texts as they pass; a SHA-256 over a text needs its parts in order,
so here one task sees all rows of a conversation, a batch at a time.

Defined cases: a null role, text, conv_id or turn is one space where the text of it is needed; a
null conv_id is a conversation, a null turn comes first and counts for no gap. Rows of one turn come
by role, then by the SHA-256 of role and text; repeated rows are rows of their own. An empty role
has no initial, so its row is never kept as it is. An empty table gives no rows. Other columns may have any name. Very long texts pass
as they are.
"""

from collections import deque
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.llm.common import small_batches
from meterflow.session import written

BLANKS = r"[^\x20\x09-\x0D]"
SEGMENT = 65_536

# Symbols: initials s, u, a and others, for rows that are sound, truncated, duplicate and blank.
INITIALS = "suao"
SOUND, TRUNCATED, DUPLICATE, BLANK = "suao", "SUAO", "1234", "5678"
INITIAL = {mark: INITIALS[i] for kind in (SOUND, TRUNCATED, DUPLICATE, BLANK)
           for i, mark in enumerate(kind)}
LEGAL = {"su", "ua", "au"}

# States of the grammar (s?(ua)+)?: nothing yet, after the system's, a user's, an assistant's row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
LAST = 4  # the exit of a segment that ends its conversation
# Where an inserted or changed row leads, and where a kept one may.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
        (USER, "a"): ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INSERT_COST, DELETE_COST, ROLE_COST, TRUNCATED_COST = 5, 2, 1, 5
NEVER = 1 << 60


def _moves():
    """{symbol: for each state, (cost, letters, next state) in the order of the letters}."""
    moves = {}
    for symbol, initial in INITIAL.items():
        must_go = symbol in DUPLICATE + BLANK
        stays = TRUNCATED_COST if symbol in TRUNCATED else 0
        moves[symbol] = []
        for state in STATES:
            found, inserted, here = [], "", state
            for count in range(3):
                cost = count * INSERT_COST
                found.append((cost + DELETE_COST, inserted + "D", here))
                if not must_go:
                    found.append((cost + stays + ROLE_COST, inserted + "R", NEXT[here]))
                    if (here, initial) in KEEP:
                        found.append((cost + stays, inserted + "K", KEEP[here, initial]))
                inserted, here = inserted + "I", NEXT[here]
            moves[symbol].append(sorted(found, key=lambda move: move[1]))
    return moves


MOVES = _moves()
ENDS = {START: (0, ""), SYSTEM: (2 * INSERT_COST, "II"), USER: (INSERT_COST, "I"),
        ASSISTANT: (0, "")}


def root(leaving):
    """The node after the last row: for each state (cost to go, letters, entry that follows)."""
    if leaving == LAST:
        return [(*ENDS[state], None) for state in STATES]
    return [(0 if state == leaving else NEVER, "", None) for state in STATES]


def node(symbol, following):
    """The node of a row before a node."""
    entries = []
    for moves in MOVES[symbol]:
        best, letters, after = NEVER, "", None
        for cost, some, state in moves:  # by letters, so the first of equal costs is the least
            total = cost + following[state][0]
            if total < best:
                best, letters, after = total, some, following[state]
        entries.append((best, letters, after))
    return entries


def audit(entry):
    """The letters from an entry to the end."""
    letters = []
    while entry is not None:
        letters.append(entry[1])
        entry = entry[2]
    return "".join(letters)


class Automaton:
    """Nodes of the signature at hand, from its end; one path for each way to leave it."""

    def __init__(self):
        self.paths = {}
        self.made = 0

    def entries(self, signature, leaving):
        """The entries before the first row of a signature."""
        known, nodes = self.paths.get(leaving, ("", [root(leaving)]))
        backwards = signature[::-1]
        shared, most = 0, min(len(known), len(backwards))
        if known[:most] == backwards[:most]:
            shared = most
        else:
            while known[shared] == backwards[shared]:
                shared += 1
        del nodes[shared + 1:]
        for symbol in backwards[shared:]:
            nodes.append(node(symbol, nodes[-1]))
        self.made += len(backwards) - shared
        self.paths[leaving] = (backwards, nodes)
        return nodes[-1]


def crossings(automaton, signature, last):
    """(entry state, leaving, cost, rank) of a segment for all its ways, ``rank`` by the audit."""
    ways = []
    for leaving in [LAST] if last else STATES:
        for state, entry in enumerate(automaton.entries(signature, leaving)):
            if entry[0] < NEVER:
                ways.append((state, leaving, entry[0], audit(entry)))
    ways.sort(key=lambda way: (way[0], way[3]))
    return [(state, leaving, cost, rank) for rank, (state, leaving, cost, _) in enumerate(ways)]


def route(segments):
    """The entry state and the way to leave of each segment in order, at the least cost; of equal
    costs the one whose audit comes first. ``segments`` holds the ``crossings`` of each."""
    ahead, choices = {LAST: 0}, []
    for ways in reversed(segments):
        best = {}
        for state, leaving, cost, rank in ways:
            if leaving in ahead:
                offer = (cost + ahead[leaving], rank, leaving)
                best[state] = min(best.get(state, offer), offer)
        choices.append({state: leaving for state, (_, _, leaving) in best.items()})
        ahead = {state: offer[0] for state, offer in best.items()}
    state, found = START, []
    for choice in reversed(choices):
        found.append((state, choice[state]))
        state = choice[state]
    return found


def _as_text(column):
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(conversations):
    """The rows after damage: ``conv_id``, ``turn``, ``role``, ``text``, ``key`` and how many
    ``copies`` of the row there are."""
    name = F.concat(_as_text(F.col("conv_id")), F.lit(":"), _as_text(F.col("turn")))
    rows = conversations.select(
        "conv_id", "turn", _as_text(F.col("role")).alias("role"),
        _as_text(F.col("text")).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("_case"),
    ).filter("_case <> 0")
    case = F.col("_case")
    text = F.when(case == 1, "").when(
        case == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.when(case == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
    whole = F.sha2(F.concat_ws("\n", "role", "text").cast("binary"), 256)
    return rows.withColumn("key", F.substring(F.unhex(whole), 1, 16))


KEY = ["conv_id", "turn", "role", "key"]


def symbols(rows):
    """Each distinct row of a turn once: ``conv_id``, ``turn``, ``role``, ``key``, ``copies``, the
    symbol of its first copy and, as ``again``, that of the others.

    The first of equal rows in a conversation is found by a minimum that is taken before the
    shuffle, and meets its row on the turn too, so many repeats of one row are one row each task.
    """
    blank = ~F.col("text").rlike(BLANKS)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    once = written(rows.select(*KEY, "copies", blank.alias("blank"), cut.alias("cut")).groupBy(
        *KEY, "blank", "cut").agg(F.sum("copies").alias("copies")), "turns-rows")
    # Nulls come first in a minimum of structs, as they do in the order of turns.
    firsts = once.groupBy("conv_id", "role", "key").agg(
        F.min(F.struct("turn")).alias("first")).select(
        "conv_id", "role", "key", F.col("first.turn").alias("turn"), F.lit(True).alias("first"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in KEY]
    marked = once.alias("a").join(firsts.alias("b"), same, "left").select("a.*", "b.first")
    place = F.instr(F.lit("sua"), F.substring("role", 1, 1))
    place = F.when((place == 0) | (F.col("role") == ""), 4).otherwise(place)

    def symbol(kind):
        return F.substring(F.lit(kind), place, F.lit(1))

    return marked.select(
        *KEY, "copies",
        F.when(F.col("blank"), symbol(BLANK)).when(F.col("first").isNull(), symbol(DUPLICATE))
        .when(F.col("cut"), symbol(TRUNCATED)).otherwise(symbol(SOUND)).alias("symbol"),
        F.when(F.col("blank"), symbol(BLANK)).otherwise(symbol(DUPLICATE)).alias("again"),
    )


def _table(rows, fields):
    """An Arrow batch of row tuples; ``fields`` are (name, type)."""
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def _rows(batch):
    return zip(*[column.to_pylist() for column in batch.columns])


def _schema(rows, names, more):
    """DDL text of columns of a frame and more."""
    kinds = dict(rows.dtypes)
    return ", ".join([f"`{name}` {kinds[name]}" for name in names] + [more])


def signatures(marked, segment=SEGMENT):
    """Segments of at most ``segment`` rows: ``conv_id``, the ``turn``, ``role`` and ``key`` they
    begin with, ``piece`` among those that begin with one row, their least and largest turn ``low``
    and ``high``, how many distinct ``turns`` they hold, and the ``signature``."""
    order = [*KEY, "copies", "symbol", "again"]

    def cut(batches):
        row, begin, parts, size, found, fields = None, None, [], 0, [], None
        piece = low = high = turns = 0

        def close():
            found.append((*begin, piece, low, high, turns, "".join(parts)))

        for batch in batches:
            own = [(name, batch.schema.field(name).type) for name in KEY]
            fields = own + [("piece", pa.int64()), ("low", own[1][1]), ("high", own[1][1]),
                            ("turns", pa.int64()), ("signature", pa.string())]
            for row in _rows(batch):
                at, left, mark, again = row[1], row[4], row[5], row[6]
                if begin is None or row[0] != begin[0] or size >= segment:
                    if begin is not None:
                        close()
                    begin, piece, parts, size = row[:4], 0, [], 0
                    low, high, turns = at, at, int(at is not None)
                elif at != high:
                    low, high, turns = at if low is None else low, at, turns + 1
                while left:
                    some = min(left, segment - size)
                    parts.append(mark + again * (some - 1))
                    size, left, mark = size + some, left - some, again
                    if left:
                        close()
                        piece = piece + 1 if begin == row[:4] else 1
                        begin, parts, size = row[:4], [], 0
                        low, high, turns = at, at, int(at is not None)
                    if len(found) >= 1024:
                        yield _table(found, fields)
                        found.clear()
        if begin is not None:
            close()
        if found:
            yield _table(found, fields)

    turn = dict(marked.dtypes)["turn"]
    more = f"piece long, low {turn}, high {turn}, turns long, signature string"
    return marked.select(*order).orderBy(*KEY).mapInArrow(cut, _schema(marked, KEY, more))


def placed(segments):
    """Segments with their ``number`` in the conversation, the ``total`` of them, and of the segment
    before its last symbol ``before`` and its largest turn ``till``."""
    inside = Window.partitionBy("conv_id").orderBy("turn", "role", "key", "piece")
    return segments.select(
        "*", F.row_number().over(inside).alias("number"),
        F.count("*").over(Window.partitionBy("conv_id")).alias("total"),
        F.lag(F.substring("signature", -1, 1)).over(inside).alias("before"),
        F.lag("high").over(inside).alias("till"),
    )


def routes(segments):
    """Where the segments of cut conversations begin and end in the grammar: ``conv_id``,
    ``number``, ``entry``, ``leaving``."""
    many = segments.filter("total > 1").select(
        "conv_id", "number", "signature", (F.col("number") == F.col("total")).alias("last"))
    many = many.repartitionByRange("last", F.reverse("signature"), "conv_id", "number")
    many = many.sortWithinPartitions("last", F.reverse("signature"))
    ways = "array<struct<entry:int,leaving:int,cost:long,rank:int>>"

    def cross(batches):
        automaton = Automaton()
        for batch in batches:
            found = [crossings(automaton, signature, last)
                     for _, _, signature, last in _rows(batch)]
            kind = pa.list_(pa.struct([("entry", pa.int32()), ("leaving", pa.int32()),
                                       ("cost", pa.int64()), ("rank", pa.int32())]))
            names = ("entry", "leaving", "cost", "rank")
            ways = pa.array([[dict(zip(names, way)) for way in some] for some in found], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), ways], names=["conv_id", "number", "ways"])

    keys = ["conv_id", "number"]
    crossed = many.mapInArrow(cross, _schema(many, keys, f"ways {ways}"))

    def choose(table):
        rows = sorted(zip(table.column("number").to_pylist(), table.column("ways").to_pylist()))
        chosen = route([[tuple(way.values()) for way in some] for _, some in rows])
        first = table.column("conv_id").slice(0, 1).combine_chunks()
        same = pa.concat_arrays([first] * len(rows))
        return pa.table({
            "conv_id": same, "number": pa.array([n for n, _ in rows], pa.int32()),
            "entry": pa.array([entry for entry, _ in chosen], pa.int32()),
            "leaving": pa.array([leaving for _, leaving in chosen], pa.int32()),
        })

    return crossed.groupBy("conv_id").applyInArrow(
        choose, _schema(many, keys, "entry int, leaving int"))


def facts(signature, before):
    """(blank, duplicate, truncated, illegal) of a segment after the symbol ``before``."""
    counts = [sum(map(signature.count, kind)) for kind in (BLANK, DUPLICATE, TRUNCATED)]
    initials = [INITIAL[symbol] for symbol in (before or "") + signature]
    return *counts, sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


FACTS = ["cost", "blank", "duplicate", "truncated", "illegal"]


def solved(segments):
    """``segments`` with their least ``cost``, the ``audit`` and what else is counted in them."""
    ways = routes(segments).alias("w")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("conv_id", "number")]
    rows = segments.alias("s").join(ways, same, "left").select(
        "s.*", F.coalesce("entry", F.lit(START)).alias("entry"),
        F.coalesce("leaving", F.lit(LAST)).alias("leaving"))
    order = ["leaving", F.reverse("signature"), "conv_id", "number"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = [*KEY, "number", "low", "high", "turns", "till"]

    def solve(batches):
        automaton, last, best = Automaton(), None, None
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist()
                       for c in ("signature", "entry", "leaving", "before"))
            for signature, entry, leaving, before in zip(*columns):
                if (signature, entry, leaving) != last:
                    last = signature, entry, leaving
                    chosen = automaton.entries(signature, leaving)[entry]
                    best = audit(chosen), chosen[0]
                found.append((*best, *facts(signature, before)))
            made = _table(found, [("audit", pa.string()), *[(f, pa.int64()) for f in FACTS]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + made.columns, names=kept + made.schema.names)

    more = "audit string, " + ", ".join(f"{name} long" for name in FACTS)
    return rows.mapInArrow(solve, _schema(rows, kept, more))


class Repair:
    """One conversation as its rows pass: the audit's letters are used up row by row."""

    def __init__(self, conv):
        self.conv, self.state = conv, START
        self.audits, self.waiting, self.used = [], deque(), 0
        self.sums, self.turns, self.low, self.high = [0] * len(FACTS), 0, None, None
        self.hash, self.rows = sha256(), 0

    def segment(self, letters, low, high, turns, till, counts):
        self.audits.append(letters)
        self.waiting.append(letters)
        self.sums = [a + b for a, b in zip(self.sums, counts)]
        self.turns += turns - (till is not None and till == low)
        self.low = low if self.low is None else self.low
        self.high = high if high is not None else self.high

    def letters(self):
        while self.waiting:
            while self.used < len(self.waiting[0]):
                self.used += 1
                yield self.waiting[0][self.used - 1]
            self.waiting.popleft()
            self.used = 0

    def put(self, role, text=""):
        self.hash.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
        self.rows += 1

    def insert(self):
        self.state = NEXT[self.state]
        self.put(ROLE[self.state])

    def row(self, role, text):
        for letter in self.letters():
            if letter == "I":
                self.insert()
                continue
            if letter == "K":
                self.state = KEEP[self.state, role[:1]]
                self.put(role, text)
            elif letter == "R":
                self.state = NEXT[self.state]
                self.put(ROLE[self.state], text)
            return

    def end(self):
        for _ in self.letters():
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, *counts = self.sums
        return (self.conv, gaps, *counts, cost, "".join(self.audits), self.hash.hexdigest())


REPAIRED = [("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"),
            ("illegal", "long"), ("cost", "long"), ("audit", "string"),
            ("repaired_sha256", "string")]


def repair(conversations, segment=SEGMENT):
    """One row per ``conv_id`` of ``conversations``: its faults after damage, the ``cost`` and
    ``audit`` of the cheapest repair, and the SHA-256 of the repaired rows."""
    small_batches(conversations.sparkSession, 4096)
    rows = damaged(conversations)
    segments = written(placed(signatures(symbols(rows), segment)), "turns-segments")
    nothing = {"number": "int", "copies": "long", "text": "string"}

    def lined(frame, head, kind, **columns):
        own = {name: F.lit(None).cast(t) for name, t in nothing.items()} | columns
        return frame.select(
            *[F.col(c) if c in frame.columns else F.lit(None).cast(kinds[c]).alias(c)
              for c in (*KEY, "low", "high", "turns", "till", *FACTS)],
            F.lit(head).alias("head"), F.lit(kind).alias("kind"),
            *[column.alias(name) for name, column in own.items()],
        )

    done = solved(segments)
    kinds = dict(done.dtypes)
    parts = [
        lined(conversations.select("conv_id").distinct(), 0, 0),
        lined(done, 1, 1, number=F.col("number"), text=F.col("audit")),
        lined(rows, 1, 2, copies=F.col("copies"), text=F.col("text")),
    ]
    order = ["conv_id", "head", "turn", "role", "key", "kind", "number"]
    stream = parts[0].unionByName(parts[1]).unionByName(parts[2])
    stream = stream.repartition("conv_id").sortWithinPartitions(*order)
    names = ["conv_id", "kind", "role", "text", "copies", "low", "high", "turns", "till", *FACTS]

    def run(batches):
        now = None
        for batch in batches:
            found = []
            for conv, kind, role, text, copies, low, high, turns, till, *counts in _rows(batch):
                if kind == 0:
                    if now:
                        found.append(now.end())
                    now = Repair(conv)
                elif kind == 1:
                    now.segment(text, low, high, turns, till, counts)
                else:
                    for _ in range(copies):
                        now.row(role, text)
            fields = [("conv_id", batch.schema.field("conv_id").type)] + [
                (name, pa.int64() if t == "long" else pa.string()) for name, t in REPAIRED]
            yield _table(found, fields)
        if now:
            yield _table([now.end()], fields)

    more = ", ".join(f"{name} {t}" for name, t in REPAIRED)
    return stream.select(*names).mapInArrow(run, _schema(conversations, ["conv_id"], more))
