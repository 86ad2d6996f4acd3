"""Secret scans: fixed patterns, and strings that are new to a dictionary-primed compressor.

Three kinds of spans come from patterns: ``assign``, ``access`` and ``hex``. Beside them, every
string of twelve or more characters within reach of a sensitive word is a candidate. The reach is
the rest of the word's statement, which ends with its line or before white space behind . ; ! or ?,
the next line with text if the statement leaves off after an opening sign, a PEM block up to its
end, a YAML block value, and in any case the next ``REACH`` characters, white space not
counted.

A zstandard compressor is primed with a dictionary of identifiers and gives the bytes that a
candidate adds to the code around it, over its length: its novelty. Plain prose goes first, so that
letters cost what they cost in words, and other candidates and spans are taken out of the
surroundings, so that a list of secrets does not teach the compressor their alphabet. What adds as
many bytes as random characters of its alphabet have entropy is reported as ``novel``. Letters alone
come near that in rare words, so their spelling is compressed instead: every letter becomes its
rank among those that follow the two before it in the words of the license texts, which are few in
words, old and new, and any in random strings. Identifiers, paths and words that the surroundings
or the dictionary hold shrink to a few bytes. A candidate that touches a pattern's span is not
reported twice.

Positions are code points, the end exclusive. Patterns match letters of ASCII only, keywords in
either case; a match that is too short is left out, and the search goes on behind it.

Defined cases: null counts as the empty text, which has no spans. Texts are scanned whole, in
time in proportion to their length. Repeated rows each get their row. An empty table gives no
rows. Other columns may have any name.
"""

import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache
from hashlib import sha256
from importlib.resources import files
from math import log2
from string import ascii_lowercase

import pandas as pd

from meterflow.llm.common import small_batches

KINDS = ("assign", "access", "hex", "novel")
AROUND = 2048
REACH = 64
# Bytes a letter that the spelling of a string of letters adds at least to be new.
SPELLING = 0.7
# Letters that words joined by their case have at least on average.
SHORTEST = 3
LEAST = 12
# Characters of prose that come before what is compressed.
PROSE = 2000

# The patterns of the base kinds and the least lengths of what they match.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Words that announce a secret, and identifiers that are none.
SENSITIVE = """
password passwd passphrase pwd secret token apikey api_key api-key access_key accesskey
private_key signing_key encryption_key client_key auth bearer basic credential credentials
authorization x-api-key session_id sessionid cookie connectionstring connection_string dsn jwt
ghp_ gho_ xoxb- xoxp- sk_live_ sk_test_ -----begin
""".split()
IDENTIFIERS = """
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 example_example placeholder
your_password_here your-api-key-here changeme undefined environment process.env.getenv
os.environ config.settings application.properties localhost:8080 https://www.example.com/path
authorization authentication authenticate credentials accessToken refreshToken access_token
refresh_token client_secret client_id session_token csrf_token tokenizer token_count max_tokens
password_reset password_hash reset_password forgot_password validate_password user_password
getPassword setPassword createToken verifyToken parseToken tokenExpired secretKey publicKey
privateKey private_key public_key api_endpoint api_version function return const static void
string boolean integer parameter response request header content-type application/json
text/plain charset=utf-8 multipart/form-data username account_number identifier description
information management service controller repository interface implementation
""".split()

SENSITIVE_BYTES = tuple(word.encode() for word in SENSITIVE)
ANNOUNCED = re.compile(
    "(?i:" + "|".join(map(re.escape, sorted(SENSITIVE, key=len, reverse=True))) + ")", re.ASCII
)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]*")
NEAR = re.compile(r"(?:\s*+\S){0,%d}" % REACH)
STATEMENT = re.compile(r"[^\n.;!?]*+(?:[.;!?](?!\s|\Z)[^\n.;!?]*+)*+")
# The next line with text behind a line that ends with an opening sign.
CONTINUED = re.compile(r"""\s*+\n\s*+[^\n]*+""")
OPENING = tuple(":=({[,|>\\\"'`")
BLOCK = re.compile(r"""["']?[ \t]*:[ \t]*[|>][-+0-9]*[ \t\r]*\n((?:[ \t]+[^\n]*(?:\n|\Z)|\r?\n)+)""")
PEM_LINES = re.compile(r"[^\n]*(?:\n[A-Za-z0-9+/=:,\x20\t\r-]*)*")
HEX_OR_NOT = bytes(49 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
HEX_RUN = b"1" * HEX_LEAST


def base_spans(text, raw, low):
    """(kind, start, end) of the patterns, for each kind from left to right without overlap."""
    spans = []
    if any(word in low for word in KEYWORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text)
                  if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_LEAST]
    if HEX_RUN in raw.translate(HEX_OR_NOT):
        spans += [("hex", *m.span()) for m in HEX.finditer(text)
                  if m.end() - m.start() >= HEX_LEAST]
    return spans


@lru_cache(maxsize=1)
def _prose():
    """The license texts as one text."""
    folder = files("meterflow.llm").joinpath("licenses")
    texts = sorted(folder.iterdir(), key=lambda text: text.name)
    return " ".join(word for text in texts for word in text.read_text("utf-8").split())


@lru_cache(maxsize=1)
def _compressor():
    """(compressor primed with the identifiers, prose that comes first)"""
    import zstandard

    known = "\n".join(IDENTIFIERS) + "\n"
    primed = zstandard.ZstdCompressionDict(
        known.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    primed.precompute_compress(level=19)
    return zstandard.ZstdCompressor(level=19, dict_data=primed), _prose()[:PROSE] + "\n"


def novelty(candidate, before, after):
    """Compressed bytes that the candidate adds to the code around it, over its length. Other
    occurrences of the candidate are taken out."""
    compressor, prose = _compressor()
    before, after = before.replace(candidate, ""), after.replace(candidate, "")
    without = len(compressor.compress((prose + before + after).encode()))
    whole = len(compressor.compress((prose + before + candidate + after).encode()))
    return (whole - without) / len(candidate)


class _Spelling:
    """Letters as their ranks behind the two letters before, in the words of a text."""

    def __init__(self, text):
        import zstandard

        words = [word for word, _ in Counter(parts_of(text)).most_common()]
        self.pairs, self.triples = Counter(), Counter()
        for word in words:
            padded = "  " + word
            for i, letter in enumerate(word):
                self.pairs[padded[i + 1], letter] += 1
                self.triples[padded[i:i + 2], letter] += 1
        self.ranks = {}
        self.known = b"".join(self.code(word) + b" " for word in words)
        self.compress = zstandard.ZstdCompressor(level=19).compress

    def code(self, word):
        padded = "  " + word
        return bytes([97 + self._order(padded[i:i + 2])[letter]
                      for i, letter in enumerate(word)])

    def _order(self, before):
        if before not in self.ranks:
            ordered = sorted(ascii_lowercase, key=lambda letter: (
                -20 * self.triples[before, letter] - self.pairs[before[1], letter], letter))
            self.ranks[before] = {letter: rank for rank, letter in enumerate(ordered)}
        return self.ranks[before]

    def novelty(self, candidate, before, after):
        around = parts_of((after + " " + before).replace(candidate, ""))
        known = self.known + b"".join(self.code(word) + b" " for word in around)
        own = b"".join(map(self.code, parts_of(candidate)))
        return (len(self.compress(known + own)) - len(self.compress(known))) / len(candidate)


@lru_cache(maxsize=1)
def _spelling():
    return _Spelling(_prose() + " " + " ".join(IDENTIFIERS))


def parts_of(text):
    """The words in a text or an identifier, in lower case."""
    return [part.lower() for part in PART.findall(text)]


def is_new(candidate, before, after):
    """Whether a string is new to the code around it. Letters whose case changes more often than in
    joined words are characters like any other."""
    changes = len(parts_of(candidate)) * SHORTEST > len(candidate)
    if changes or any(map(str.isdigit, candidate)):
        return novelty(candidate, before, after) >= alphabet_bytes(candidate)
    return _spelling().novelty(candidate, before, after) >= SPELLING


def alphabet_bytes(candidate):
    """Bytes of entropy of a random character of the classes that a string is made of."""
    kinds = ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10))
    size = sum(n for has, n in kinds if any(map(has, candidate)))
    return log2(size + 4 * any(c in "+/_=-" for c in candidate)) / 8


def _reach(text, word, statement):
    """Where the last candidate behind a sensitive word may begin, given its statement's end."""
    end = word.end()
    if word[0].lower() == "-----begin":
        closed = text.find("-----END", end)
        opened = text.find("-----BEGIN", end)
        if closed >= 0 and not 0 <= opened < closed:
            return closed
        return PEM_LINES.match(text, end).end()
    reach = max(statement, NEAR.match(text, end).end())
    if text[:statement].endswith(OPENING, end):
        following = CONTINUED.match(text, statement)
        reach = max(reach, following.end() if following else 0)
    block = BLOCK.match(text, end)
    return max(reach, block.end(1)) if block else reach


def candidates(text):
    """Spans of the strings within reach of sensitive words, in order."""
    spans, done, statement, parts = [], 0, 0, []
    for word in ANNOUNCED.finditer(text):
        if word.end() > statement:
            statement = STATEMENT.match(text, word.end()).end()
        reach = _reach(text, word, statement)
        if parts and word.start() <= parts[-1][1]:
            parts[-1][1] = max(parts[-1][1], reach)
        else:
            parts.append([word.start(), reach])
    for start, reach in parts:
        # A string may go on beyond the reach that it begins in.
        for found in CANDIDATE.finditer(text, max(start, done), RUN.match(text, reach).end()):
            if found.start() <= reach:
                spans.append(found.span())
                done = found.end()
    return spans


def _without(text, start, end, others):
    """Text from start to end without the parts that others, spans in order, have in it."""
    parts, at = [], start
    for a, b in others:
        if b > at and a < end:
            parts.append(text[at:max(at, a)])
            at = max(at, b)
    return "".join(parts) + text[at:max(at, end)]


def _touches(span, spans):
    """Whether a span overlaps one of others in order, of which at most one of a kind stands in a
    place."""
    at = bisect_left(spans, span)
    return any(span[0] < b and a < span[1] for a, b in spans[max(0, at - len(KINDS)):at + 1])


def novel_spans(text, low, taken):
    """Spans of incompressible strings within reach of sensitive words."""
    if not any(word in low for word in SENSITIVE_BYTES):
        return []
    fixed = sorted((a, b) for _, a, b in taken)
    found = [span for span in candidates(text) if not _touches(span, fixed)]
    secret = sorted(found + fixed)
    begins = [a for a, _ in secret]
    longest = max((b - a for a, b in secret), default=0)
    spans = []
    for start, end in found:
        near = secret[bisect_left(begins, start - AROUND - longest):
                      bisect_left(begins, end + AROUND)]
        before = _without(text, max(0, start - AROUND), start, near)
        after = _without(text, end, min(len(text), end + AROUND), near)
        string = text[start:end]
        if is_new(string, before, after):
            spans.append(("novel", start, end))
    return spans


def joined(spans):
    """Spans in order of their start, then of their kind."""
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def scan(text):
    """(spans of the patterns, spans that the compressor adds) of one text."""
    text = text or ""
    raw = text.encode()
    low = raw.lower()
    base = base_spans(text, raw, low)
    return base, novel_spans(text, low, base)


def scan_documents(docs):
    """One row per document: ``doc_id``, the number of spans of each kind, ``base_sha256`` of the
    joined spans of the patterns, and all ``spans`` joined."""
    def rows(batches):
        for batch in batches:
            made = []
            for text in batch["text"]:
                base, added = scan(text)
                kinds = [span[0] for span in base]
                made.append((
                    kinds.count("assign"), kinds.count("access"), kinds.count("hex"), len(added),
                    sha256(joined(base).encode()).hexdigest(), joined(base + added),
                ))
            columns = ["n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
            yield pd.concat([batch[["doc_id"]], pd.DataFrame(made, columns=columns)], axis=1)

    small_batches(docs.sparkSession)
    doc_id = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        rows, f"doc_id {doc_id}, n_assign long, n_access long, n_hex long, n_novel long, "
        "base_sha256 string, spans string"
    )
