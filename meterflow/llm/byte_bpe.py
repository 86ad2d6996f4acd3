"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts are laid end to end as code points. An array gives each code point its class; class and the
two next code points give a symbol; and a symbol stands for a function from the state of a small
automaton to its next state. Such functions compose associatively, so the state before every
code point comes from a scan over blocks: the functions of a block are composed column by column,
the blocks' functions are scanned the same way, and the states run through the columns once. Where
the automaton opens a piece is a table of state and symbol; no regular expression is involved. The
slices between these places go to a cache of merged pieces. A piece that is no token itself is
merged pair by pair, the lowest rank first, the leftmost of equals. The byte offset of every
token stays beside its id, so that any range of tokens can be decoded or found in its text.

Pieces are those of the pattern published with the vocabulary: the contractions 's 't 're 've 'm
'll 'd, runs of letters, of numbers and of other signs, each with one space before it, and white
space, of which the last character is left to what follows.

Defined cases: null counts as the empty text, which has no ids. A text of any length is taken in
blocks, and of its pieces only those of one block are held. Repeated rows each get their row;
other columns may have any name. An empty table gives no rows. A vocabulary has to hold all 256
bytes.
"""

import base64
import heapq
import struct
import unicodedata
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import functions as F

from meterflow.llm.common import ship, small_batches

# Code points of one block, and of the texts laid end to end at a time.
BLOCK = 1 << 19
# Columns of a block in the scan.
WIDTH = 64
# Merged pieces a worker keeps, and the length in bytes up to which it keeps them.
KEPT_PIECES = 500_000
KEPT_BYTES = 64
# Length in bytes up to which a list of pairs is merged faster than a heap of them.
FEW_BYTES = 40
NEVER = 1 << 62

# Letters and numbers of Unicode 16, which the tokenizer knows, that are not yet in
# Unicode 15.1.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
# The characters with Unicode's property White_Space.
WHITE_SPACE = [
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]

# Classes of code points; the end of a text is a class of its own.
LETTER, NUMBER, SIGN, BLANK, SPACE, QUOTE, END = range(7)
# Symbols: the first three as above, a quote that begins a contraction of one or two letters, a
# space or another blank before anything else, a blank before a blank or the end, the end of a
# text, and nothing at all.
SHORT, LONG, LAST_SPACE, LAST_BLANK, INNER_BLANK, CLOSE, NOTHING = range(3, 10)
# States: a piece is complete; inside letters, numbers or signs; after a space that joins what
# follows; inside blanks; one or two letters of a contraction to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_SIGNS, JOINING, IN_BLANKS, ONE_MORE, TWO_MORE = range(8)
STATES = 8


@lru_cache(maxsize=1)
def classes():
    """The class of every code point."""
    kind = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kind.get(unicodedata.category(chr(c))[0], SIGN) for c in range(0x110000)), np.uint8
    )
    for ranges, value in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER), (WHITE_SPACE, BLANK)):
        for first, last in ranges:
            table[first:last + 1] = value
    table[ord(" ")], table[ord("'")] = SPACE, QUOTE
    return table


def _automaton():
    """Next state and whether a piece begins, by symbol and state."""
    begin = {
        LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, SIGN: IN_SIGNS, SHORT: ONE_MORE, LONG: TWO_MORE,
        LAST_SPACE: JOINING, LAST_BLANK: FRESH, INNER_BLANK: IN_BLANKS, CLOSE: FRESH,
    }
    after = np.zeros((NOTHING + 1, STATES), np.uint8)
    opens = np.zeros((NOTHING + 1, STATES), bool)
    for symbol, state in begin.items():
        after[symbol], opens[symbol] = state, True
    goes_on = {
        IN_LETTERS: {LETTER: IN_LETTERS},
        IN_NUMBERS: {NUMBER: IN_NUMBERS},
        IN_SIGNS: dict.fromkeys((SIGN, SHORT, LONG), IN_SIGNS),
        JOINING: {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS,
                  **dict.fromkeys((SIGN, SHORT, LONG), IN_SIGNS)},
        IN_BLANKS: {INNER_BLANK: IN_BLANKS},
        ONE_MORE: {LETTER: FRESH},
        TWO_MORE: {LETTER: ONE_MORE},
    }
    for state, moves in goes_on.items():
        for symbol, to in moves.items():
            after[symbol, state], opens[symbol, state] = to, False
    after[NOTHING], opens[NOTHING] = np.arange(STATES), False
    return after, opens


AFTER, OPENS = _automaton()


def symbols_of(codes, kinds):
    """The symbol of every code point but the last two, which only say what follows."""
    here, following = kinds[:-2], kinds[1:-1]
    symbols = here.copy()
    symbols[here == END] = CLOSE
    solid = (following <= SIGN) | (following == QUOTE)
    for kind, last in ((SPACE, LAST_SPACE), (BLANK, LAST_BLANK)):
        at = here == kind
        symbols[at] = np.where(solid[at], last, INNER_BLANK)
    quotes = np.flatnonzero(here == QUOTE)
    one, two = codes[quotes + 1], codes[quotes + 2]
    single, double = np.zeros(len(quotes), bool), np.zeros(len(quotes), bool)
    for letter in "stmd":
        single |= one == ord(letter)
    for first, second in ("re", "ve", "ll"):
        double |= (one == ord(first)) & (two == ord(second))
    symbols[quotes] = np.where(single, SHORT, np.where(double, LONG, SIGN))
    return symbols


def _columns(items, filler):
    """``items`` as rows of ``WIDTH``, the last one filled up."""
    rows = -(-len(items) // WIDTH)
    full = np.empty((rows * WIDTH, *items.shape[1:]), items.dtype)
    full[:len(items)], full[len(items):] = items, filler
    return full.reshape(rows, WIDTH, *items.shape[1:])


def entries(functions, state):
    """The state before each of a sequence of functions, given the state before all of them."""
    if len(functions) <= WIDTH:
        states = np.empty(len(functions), np.uint8)
        for i, function in enumerate(functions):
            states[i], state = state, function[state]
        return states
    rows = _columns(functions, np.arange(STATES, dtype=np.uint8))
    whole = rows[:, 0]
    for column in range(1, WIDTH):
        whole = np.take_along_axis(rows[:, column], whole, axis=1)
    states = np.empty(rows.shape[:2], np.uint8)
    now, row = entries(whole, state), np.arange(len(rows))
    for column in range(WIDTH):
        states[:, column] = now
        now = rows[row, column, now]
    return states.reshape(-1)[:len(functions)]


def scan(symbols, state):
    """Whether a piece begins at each symbol, and the state after the last one."""
    rows = _columns(symbols, NOTHING).T.astype(np.intp) * STATES
    after, opens = AFTER.reshape(-1), OPENS.reshape(-1)
    whole = after[rows[0][:, None] + np.arange(STATES)]
    for column in rows[1:]:
        whole = after[column[:, None] + whole]
    now = entries(whole, state)
    begins = np.empty(rows.shape, bool)
    for i, column in enumerate(rows):
        place = column + now
        begins[i], now = opens[place], after[place]
    return begins.T.reshape(-1)[:len(symbols)], int(now[-1])


def _offsets(text, size, cuts):
    """Byte offsets of places in a text of so many bytes."""
    if size == len(text):
        return cuts
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    return np.concatenate(([0], np.cumsum(width)))[cuts]


def slices(texts, block=BLOCK):
    """(number of the text, some of its pieces as bytes, whether they are the last) in order."""
    joined = "\0".join(texts) + "\0"
    ends = np.cumsum([len(text) + 1 for text in texts]) - 1
    state, begin, number, done = FRESH, 0, 0, -1
    for at in range(0, len(joined), block):
        size = min(block, len(joined) - at)
        codes = np.zeros(size + 2, np.uint32)
        some = np.frombuffer(joined[at:at + size + 2].encode("utf-32-le"), np.uint32)
        codes[:len(some)] = some
        kinds = classes()[codes]
        first, last = np.searchsorted(ends, [at, at + size + 2])
        kinds[ends[first:last] - at] = END
        kinds[len(some):] = END
        begins, state = scan(symbols_of(codes, kinds), state)
        cuts = np.flatnonzero(begins) + at
        if not len(cuts):
            continue
        if cuts[0] != begin:
            cuts = np.concatenate(([begin], cuts))
        part = joined[begin:cuts[-1]]
        data = part.encode()
        places = _offsets(part, len(data), cuts - begin).tolist()
        pieces = [data[a:b] for a, b in zip(places, places[1:])]
        start = int(begin == done)  # the mark that ended the text before
        first, last = np.searchsorted(ends, [done + 1, cuts[-1] + 1])
        for mark in np.searchsorted(cuts, ends[first:last]).tolist():
            yield number, pieces[start:mark], True
            start, number = mark + 1, number + 1
        if last > first:
            done = int(ends[last - 1])
        if start < len(pieces):
            yield number, pieces[start:], False
        begin = int(cuts[-1])


class Vocabulary(dict):
    """Pieces as bytes to their ids as bytes, little-endian and 32 bits each; ranks are ids.

    When half of the room is full, what was kept before goes, and what is asked for again moves
    on; so frequent pieces stay.
    """

    def __init__(self, path, kept=KEPT_PIECES):
        super().__init__()
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.half, self.older = max(1, kept // 2), {}
        size = 1 + max(self.ranks.values())
        self.tokens, self.lengths = [b""] * size, np.zeros(size, np.int64)
        for token, rank in self.ranks.items():
            self.tokens[rank], self.lengths[rank] = token, len(token)
        self.decimals = list(map(str, range(size)))

    def __missing__(self, piece):
        ids = self.older.get(piece)
        if ids is None:
            rank = self.ranks.get(piece)
            ranks = self.merge(piece) if rank is None else (rank,)
            ids = struct.pack(f"<{len(ranks)}I", *ranks)
        if len(piece) <= KEPT_BYTES:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece):
        """The ids of a piece: the pair of lowest rank joined first, the leftmost of equals."""
        return (self.merge_few if len(piece) <= FEW_BYTES else self.merge_many)(piece)

    def merge_few(self, piece):
        find, parts = self.ranks.get, [piece[i:i + 1] for i in range(len(piece))]
        pairs = [find(piece[i:i + 2], NEVER) for i in range(len(piece) - 1)]
        while pairs and (lowest := min(pairs)) < NEVER:
            i = pairs.index(lowest)
            del pairs[i]
            parts[i] += parts.pop(i + 1)
            if i < len(pairs):
                pairs[i] = find(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = find(parts[i - 1] + parts[i], NEVER)
        return [self.ranks[part] for part in parts]

    def merge_many(self, piece):
        """The same in time that grows little faster than the piece.

        Tokens are a linked list of where they begin; a heap holds candidate pairs, and those that
        a merge has overtaken are passed over.
        """
        ranks, size = self.ranks, len(piece)
        after, before, pairs = [*range(1, size + 1), size], [*range(-1, size)], []
        gone = bytearray(size + 1)

        def offer(begin):
            middle = after[begin]
            if middle < size:
                rank = ranks.get(piece[begin:after[middle]])
                if rank is not None:
                    heapq.heappush(pairs, (rank, begin, after[middle]))

        for begin in range(size - 1):
            offer(begin)
        while pairs:
            _, begin, end = heapq.heappop(pairs)
            if gone[begin] or after[begin] >= size or after[after[begin]] != end:
                continue
            gone[after[begin]] = 1
            after[begin], before[end] = end, begin
            offer(begin)
            if begin:
                offer(before[begin])
        return [ranks[piece[b:after[b]]] for b in range(size) if not gone[b]]

    def encode(self, pieces):
        """The ids of pieces, as an array."""
        return np.frombuffer(b"".join([self[piece] for piece in pieces]), "<u4")

    def offsets(self, ids):
        """The byte in the text at which each token begins."""
        return np.cumsum(self.lengths[ids]) - self.lengths[ids]

    def decode(self, ids):
        """The bytes of ids."""
        return b"".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def _vocabulary(name):
    return Vocabulary(SparkFiles.get(name))


def grouped(texts, most=BLOCK):
    """Lists of texts of about ``most`` code points."""
    group, size = [], 0
    for text in texts:
        group.append("" if text is None else text)
        size += len(group[-1])
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def encoded_texts(vocabulary, texts):
    """(ids, byte offsets) of each text, null as empty."""
    for group in grouped(texts):
        parts = []
        for _, pieces, last in slices(group):
            parts.append(vocabulary.encode(pieces))
            if last:
                ids, parts = np.concatenate(parts), []
                yield ids, vocabulary.offsets(ids)


def digests(vocabulary, texts):
    """(number of ids, SHA-256 of the ids as decimal text, SHA-256 of the decoded bytes) of each
    text; a long one is never held as ids."""
    for group in grouped(texts):
        count, ids_hash, decoded_hash = 0, sha256(), sha256()
        for _, pieces, last in slices(group):
            ids = vocabulary.encode(pieces).tolist()
            if ids:
                text = " ".join([vocabulary.decimals[i] for i in ids])
                ids_hash.update((" " + text if count else text).encode())
                decoded_hash.update(vocabulary.decode(ids))
                count += len(ids)
            if last:
                yield count, ids_hash.hexdigest(), decoded_hash.hexdigest()
                count, ids_hash, decoded_hash = 0, sha256(), sha256()


def encode(docs, ranks_path):
    """``docs`` with an added last column ``encoded``: a struct of ``ids`` and of ``offsets``, the
    byte of the text's UTF-8 at which each token begins."""
    name = ship(docs.sparkSession, ranks_path)
    small_batches(docs.sparkSession)

    @F.pandas_udf("ids array<int>, offsets array<long>")
    def ids(texts: pd.Series) -> pd.DataFrame:
        rows = [(list(map(int, i)), o.tolist()) for i, o in encoded_texts(_vocabulary(name), texts)]
        return pd.DataFrame(rows, columns=["ids", "offsets"])

    return docs.withColumn("encoded", ids("text"))


def decode(encoded, ranks_path):
    """``encoded`` with an added last column ``decoded``: the bytes of its ids."""
    name = ship(encoded.sparkSession, ranks_path)

    @F.pandas_udf("binary")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([_vocabulary(name).decode(i) for i in ids], dtype=object)

    return encoded.withColumn("decoded", text("encoded.ids"))


def encode_digests(docs, ranks_path):
    """One row per document: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    name = ship(docs.sparkSession, ranks_path)
    small_batches(docs.sparkSession)

    def digest(batches):
        vocabulary = _vocabulary(name)
        for batch in batches:
            rows = list(digests(vocabulary, batch["text"]))
            made = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield pd.concat([batch[["doc_id"]], made], axis=1)

    doc_id = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        digest, f"doc_id {doc_id}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
