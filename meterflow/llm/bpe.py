"""BPE encoding and decoding with a lexicon of frequent words.

The words of all texts are counted; the frequent ones are compiled with their ids into a
minimal transducer, a file that every executor gets and maps into memory. Encoding looks a word
up there and merges its symbols by the tokenizer's ranks if it is not found, so the lexicon
changes the speed and never the ids.

The tokenizer is a file of the tokenizers library of the kind that ``word_bpe_49k.json`` is:
NFC, lower case, white space dropped, words split by the file's pattern, byte symbols, and a
mark at the end of words. Its special tokens are recognised in texts. Without a decoder in the
file, decoding joins the tokens with spaces, as the library does.

Defined cases: null counts as the empty text, which has no ids. Very long words are merged with
a heap, in time that grows little faster than their length. Repeated rows each get their row;
other columns may have any name. An empty table gives no rows and an empty lexicon.
"""

import heapq
import json
import os
import struct
import tempfile
from collections import Counter
from functools import lru_cache
from hashlib import sha256
from unicodedata import normalize

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import functions as F

from meterflow.llm.common import frequent, ship, small_batches
from meterflow.llm.transducer import Transducer, compile_words
from meterflow.session import written

# Words in the lexicon at most, none over ``LONGEST_WORD`` bytes; it goes to every executor.
LEXICON_WORDS = 200_000
# Pieces a worker keeps: encoded ones, and counted ones before they go on.
KEPT_PIECES = 500_000
# Symbols of a word beyond which it is merged with a heap and its ids are not kept.
LONG = 200
END = "</w>"
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
NEVER = 1 << 62
# White space to Python, but not to the tokenizer's pattern.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_symbols():
    """The character that stands for each byte: itself where it can be seen, and otherwise the
    next free one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, free = {b: chr(b) for b in seen}, 256
    for byte in range(256):
        if byte not in symbols:
            symbols[byte], free = chr(free), free + 1
    return [symbols[byte] for byte in range(256)]


class Tokenizer:
    """The parts of a tokenizer file that encoding and decoding need."""

    def __init__(self, path):
        import regex

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ids = {**vocabulary, **self.special}
        self.tokens = [""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = [vocabulary[s] for s in symbols]
        self.final = [vocabulary[s + END] for s in symbols]
        # Pair of ids to the rank of its merge and the id it becomes, in one number.
        self.merges = {}
        for rank, pair in enumerate(content["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocabulary[a], vocabulary[b]] = rank << ID_BITS | vocabulary[a + b]
        # The file's pattern; its \s is the White_Space property, which Python's is not quite.
        split = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_of = regex.compile(split.replace(r"\s", r"\p{White_Space}")).findall
        self.specials_of = regex.compile(
            "(" + "|".join(map(regex.escape, self.special)) + ")"
        ).split

    def words(self, text):
        """The words of a text without special tokens."""
        if not text.isascii():
            # Letter by letter, as the library does: no final form of sigma.
            text = normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return [text] if text.isalpha() else self.words_of(text)

    def pieces(self, text):
        """Stretches of a text that hold whole words, and special tokens as they are.

        No word, no composition and no change of case reaches over white space, so a text is
        cut there, where Python's idea of white space is the pattern's.
        """
        parts = self.specials_of(text) if "<|" in text else [text]
        found = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append(part)
            else:
                found += [part] if any(c in part for c in SEPARATORS) else part.split()
        return found

    def merge(self, word):
        """Ids of a word: the adjacent pair of lowest rank, leftmost first, becomes one."""
        data = word.encode()
        ids = [self.inner[byte] for byte in data]
        ids[-1] = self.final[data[-1]]
        if len(ids) > LONG:
            return self._merge_long(ids)
        get = self.merges.get
        ranks = [get(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [best & ID_MASK]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), NEVER)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), NEVER)
        return ids

    def _merge_long(self, ids):
        """The same with a heap, in time that grows little faster than the word."""
        end = len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = []

        def push(i):
            j = after[i]
            if j < end and (found := self.merges.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (found >> ID_BITS, i, ids[i], ids[j], found & ID_MASK))

        for i in range(end - 1):
            push(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= end or ids[j] != b:
                continue
            ids[i], ids[j] = merged, None
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [i for i in ids if i is not None]

    def text(self, ids):
        """Decoded text, special tokens included."""
        return " ".join(map(self.tokens.__getitem__, ids))


class Encoder(dict):
    """Pieces of text to their ids as bytes; a piece is looked up or merged once and kept for a
    while, as a piece and as the words in it.

    When half of the room is full, what was kept before goes, and what is asked for again moves
    on; so frequent pieces stay.
    """

    def __init__(self, tokenizer, lexicon, kept=KEPT_PIECES):
        super().__init__()
        self.tokenizer, self.lexicon, self.half = tokenizer, lexicon, max(1, kept // 2)
        self.older, self.known, self.older_known = {}, {}, {}

    def _ids(self, word):
        ids = self.known.get(word)
        if ids is None:
            if len(self.known) >= self.half // 2:
                self.known, self.older_known = {}, self.known
            ids = self.older_known.get(word)
            if ids is None:
                numbers = self.lexicon.get(word.encode()) if self.lexicon else None
                if numbers is None:
                    numbers = self.tokenizer.merge(word)
                ids = struct.pack(f"<{len(numbers)}I", *numbers)
            self.known[word] = ids
        return ids

    def __missing__(self, piece):
        ids = self.older.get(piece)
        if ids is None:
            if piece in self.tokenizer.special:
                ids = struct.pack("<I", self.tokenizer.special[piece])
            else:
                ids = b"".join([self._ids(word) for word in self.tokenizer.words(piece)])
        if len(piece) <= LONG:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text):
        """The ids of a text, as bytes."""
        return b"".join([self[piece] for piece in self.tokenizer.pieces(text or "")])

    def decode(self, ids):
        """The text of ids as bytes."""
        return self.tokenizer.text(memoryview(ids).cast("I"))


@lru_cache(maxsize=2)
def _tokenizer(name):
    return Tokenizer(SparkFiles.get(name))


@lru_cache(maxsize=2)
def _encoder(name, lexicon):
    return Encoder(_tokenizer(name), Transducer(SparkFiles.get(lexicon)))


def word_counts(docs, name, kept=KEPT_PIECES):
    """How often each word occurs in all texts: ``word``, ``n``."""
    def count(batches):
        tokenizer, pieces = _tokenizer(name), Counter()

        def rows():
            counts = Counter()
            for piece, n in pieces.items():
                if piece not in tokenizer.special:
                    for word in tokenizer.words(piece):
                        counts[word] += n
            pieces.clear()
            return pd.DataFrame({
                "word": pd.Series(list(counts), dtype=object),
                "n": pd.Series(list(counts.values()), dtype="int64"),
            })

        for batch in batches:
            for text in batch["text"]:
                pieces.update(tokenizer.pieces(text or ""))
                if len(pieces) > kept:
                    yield rows()
        if pieces:
            yield rows()

    small_batches(docs.sparkSession)
    counted = docs.select("text").mapInPandas(count, "word string, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("n")), "bpe-words")


def build_lexicon(docs, tokenizer_path, most=LEXICON_WORDS):
    """Names, on the executors, of the tokenizer file and of the compiled lexicon."""
    spark = docs.sparkSession
    name = ship(spark, tokenizer_path)
    rows = frequent(word_counts(docs, name), most)
    words = [row.word for row in rows.select("word").collect()] if rows is not None else []
    tokenizer = Tokenizer(tokenizer_path)
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "lexicon")
        compile_words({word.encode(): tokenizer.merge(word) for word in words}, path)
        return name, ship(spark, path)


def encode(docs, tokenizer_path, most=LEXICON_WORDS):
    """``docs`` with an added last column ``encoded``: a struct of ``ids``, little-endian 32-bit
    numbers, and the ``decoded`` text."""
    name, lexicon = build_lexicon(docs, tokenizer_path, most)
    small_batches(docs.sparkSession)

    @F.pandas_udf("ids binary, decoded string")
    def both(texts: pd.Series) -> pd.DataFrame:
        encoder = _encoder(name, lexicon)
        ids = [encoder.encode(text) for text in texts]
        return pd.DataFrame({"ids": ids, "decoded": [encoder.decode(i) for i in ids]})

    return docs.withColumn("encoded", both("text"))


def encode_digests(docs, tokenizer_path, most=LEXICON_WORDS):
    """One row per document: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    name, lexicon = build_lexicon(docs, tokenizer_path, most)
    small_batches(docs.sparkSession)

    def digests(batches):
        encoder = _encoder(name, lexicon)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = encoder.encode(text)
                rows.append((len(ids) // 4, sha256(ids).hexdigest(),
                             sha256(encoder.decode(ids).encode()).hexdigest()))
            made = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield pd.concat([batch[["doc_id"]], made], axis=1)

    doc_id = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        digests, f"doc_id {doc_id}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
