"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities of a fixed word list and of a lexicon learned from the
labels, closeness of such words to second-person words, rates of capitals, of punctuation and of
obfuscation, and the length. The learned lexicon holds words and word beginnings that are much
more frequent in toxic texts. A labelled text's features come from the lexicon of the other
folds, and the calibration from trees of the other folds, so nothing is judged on itself.

The classifier is fitted on about ``SAMPLE`` labelled rows, chosen by a hash of their id, all of
them if there are fewer; rows whose crc32 of the id as text is 0 modulo 5 are never among them.
The sample's ids are broadcast; its texts are counted by Spark, and the driver gets the tokens of
the sample that are strong enough (a weight of ``STRONG``, ``LEAST_TEXTS`` toxic texts) and one
row of numbers per sampled text. Words over ``LONGEST`` bytes are tokens by their beginnings only.
Every text is scored whole.

Defined cases: null counts as the empty text, which is scored like any other. With no usable
label every score is 0; with labels of one class it is that class. Several labels of one id
count as their largest; a label without a document, or null, is left out. A null id is held out
of the fit. Other columns may have any name.
"""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from meterflow.llm.boosting import Isotonic, Trees
from meterflow.llm.common import held_out, small_batches
from meterflow.session import written

SAMPLE = 24_000
FOLDS = 3
LEAST_TEXTS = 3
STRONG = 1.5
LONGEST = 64
BEGINNINGS = (4, 5, 6)
NEAR = 5

# Insults, and words that address someone, in the four languages of the corpus.
INSULTS = """
idiot idiots moron morons stupid dumb fool loser losers scum trash garbage pathetic worthless
disgusting clown clowns imbecile jerk bastard bitch crap damn shit fuck fucking asshole hate
kill retard pig rat vermin filth ugly
dumm dumme dummkopf trottel arschloch scheisse scheiße abschaum verlierer ekelhaft wertlos
schwein blöd hass
imbécile crétin connard salaud merde ordure minable dégoûtant stupide débile haine
idiota estúpido estúpida imbécil basura escoria asqueroso patético mierda cabrón tonto odio
""".split()
ADDRESS = """
you your yours yourself u ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous
votre vos usted ustedes tú ti vosotros vuestro
""".split()

INSULT = frozenset(word.encode() for word in INSULTS)
SECOND_PERSON = frozenset(word.encode() for word in ADDRESS)
APART = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
CAPITALS = bytes(range(65, 91))
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
# Digits and signs that stand for letters inside a word.
LOOKALIKE = bytes.maketrans(b"013457@$!|", b"oieastasil")
MIXED = re.compile(rb"[a-z]+[0-9@$!|*_.\-]+[a-z][a-z0-9@$!|*_.\-]*")
REPEATED = re.compile(rb"([a-z])\1\1")
SINGLES = re.compile(rb"(?<![^ ])(?:[a-z][ .\-_*]){3,}[a-z](?![^ ])")

NAMES = ["insults", "insult_words", "lexicon_words", "lexicon_density", "lexicon_most",
         "lexicon_sum", "beginning_words", "beginning_most", "beginning_sum", "address",
         "near_address", "capitals", "capital_words", "exclamations", "questions", "marks",
         "mixed", "repeated", "hidden_insults", "length"]


def words_of(text):
    """Lower-case words as bytes, cut at everything that is no letter or digit."""
    return text.encode().lower().translate(APART).split()


def tokens_of(distinct):
    """The words, and their beginnings marked with a star."""
    tokens = {word for word in distinct if len(word) <= LONGEST}
    for size in BEGINNINGS:
        tokens.update([word[:size] + b"*" for word in distinct if len(word) > size])
    return tokens


def features(text, lexicon):
    """The numbers of ``NAMES`` for one text; ``lexicon`` maps tokens to their weight."""
    raw = (text or "").encode()
    low = raw.lower()
    words = low.translate(APART).split()
    n, size = max(1, len(words)), max(1, len(raw))
    distinct = set(words)
    found = lexicon.keys() & tokens_of(distinct)
    whole = {token: lexicon[token] for token in found if not token.endswith(b"*")}
    starts = {token: lexicon[token] for token in found if token.endswith(b"*")}
    plain = INSULT & distinct
    hits, talks = plain | whole.keys(), distinct & SECOND_PERSON
    times = sum(map(words.count, plain))
    often = sum(map(whole.__contains__, words)) if whole else 0
    near = spoken = 0
    if talks:
        spoken = sum(map(words.count, talks))
        if hits:
            at = [i for i, word in enumerate(words) if word in talks]
            near = sum(1 for i in at if not hits.isdisjoint(words[max(0, i - NEAR):i + NEAR + 1]))
    mixed = MIXED.findall(low)
    hidden = 0
    for word in [*mixed, *SINGLES.findall(low)]:
        letters = word.translate(LOOKALIKE, b"*_.- ")
        if letters not in distinct and (letters in INSULT or letters in lexicon):
            hidden += 1
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    shouted = 0
    if capitals > 0.2 * size:
        shouted = sum(1 for word in raw.translate(APART).split() if len(word) > 2 and
                      word.isupper())
    return [
        100 * times / n, len(plain), len(whole), 100 * often / n,
        max(whole.values(), default=0.0), sum(whole.values()),
        len(starts), max(starts.values(), default=0.0), sum(starts.values()),
        100 * spoken / n, near, capitals / size, shouted / n,
        100 * raw.count(b"!") / size, 100 * raw.count(b"?") / size,
        (len(raw) - len(raw.translate(None, MARKS))) / size,
        100 * len(mixed) / n, 100 * len(REPEATED.findall(low)) / n, hidden, math.log(n),
    ]


def _chosen(labels, sample):
    """Ids, classes and folds of the labelled rows to fit on."""
    rows = labels.filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), 5)
    ).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = written(rows, "toxicity-labels")
    scale = 1 << 30
    share = min(1.0, sample / max(1, rows.count()))
    kept = F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < int(share * scale)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    return rows.filter(kept).withColumn("fold", fold)


def _token_counts(sample):
    """Texts of the sample that hold each token, by fold and class."""
    def count(batches):
        counter = Counter()
        for batch in batches:
            for text, toxic, fold in zip(batch["text"], batch["toxic"], batch["fold"]):
                cell = 2 * fold + toxic
                for token in tokens_of(set(words_of(text or ""))):
                    counter[token, cell] += 1
            if len(counter) > 300_000:
                yield _counted(counter)
                counter = Counter()
        if counter:
            yield _counted(counter)

    counted = sample.select("text", "toxic", "fold").mapInPandas(
        count, "token binary, cell int, n long"
    )
    cells = [F.sum(F.when(F.col("cell") == i, F.col("n")).otherwise(0)).alias(f"c{i}")
             for i in range(2 * FOLDS)]
    return counted.groupBy("token").agg(*cells)


def _counted(counter):
    return pd.DataFrame({
        "token": [token for token, _ in counter], "cell": [cell for _, cell in counter],
        "n": list(counter.values()),
    })


class Lexicon:
    """Weights of tokens: the log of how much more often toxic texts hold them."""

    def __init__(self, tokens, cells, texts):
        self.tokens, self.cells, self.texts = tokens, cells, texts

    def weights(self, without=None):
        """{token: weight} of the strong tokens; ``without`` leaves one fold out."""
        cells, texts = self.cells.copy(), self.texts.copy()
        if without is not None:
            cells[:, without] = texts[without] = 0
        toxic, clean = cells[:, :, 1].sum(1), cells[:, :, 0].sum(1)
        all_clean, all_toxic = texts.sum(0)
        weight = np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))
        good = (weight >= STRONG) & (toxic >= LEAST_TEXTS - 1)
        return {self.tokens[i]: float(weight[i]) for i in np.flatnonzero(good)}


def _lexicon(sample):
    texts = np.zeros((FOLDS, 2))
    for row in sample.groupBy("fold", "toxic").count().collect():
        texts[row.fold, int(row.toxic > 0)] = row["count"]
    clean, toxic = texts.sum(0)
    with_it = sum(F.col(f"c{2 * i + 1}") for i in range(FOLDS))
    without = sum(F.col(f"c{2 * i}") for i in range(FOLDS))
    weight = F.log((with_it + 0.5) / (toxic + 1)) - F.log((without + 0.5) / (clean + 1))
    strong = (with_it >= LEAST_TEXTS) & (weight >= STRONG)
    rows = sorted(_token_counts(sample).filter(strong).collect())
    cells = np.array([r[1:] for r in rows], float).reshape(len(rows), FOLDS, 2)
    return Lexicon([bytes(r.token) for r in rows], cells, texts)


class Model:
    """Scores texts; small enough to broadcast."""

    def __init__(self, weights, trees, calibration):
        self.weights, self.trees, self.calibration = weights, trees, calibration

    def scores(self, texts):
        rows = np.array([features(text, self.weights) for text in texts], float)
        if not len(rows):
            return np.zeros(0)
        return np.clip(self.calibration.share(self.trees.raw(rows.reshape(len(texts), -1))), 0, 1)


def fit(docs, labels, sample=SAMPLE):
    """The model from the labelled rows among ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    chosen = F.broadcast(_chosen(labels, sample))
    rows = written(docs.select("doc_id", "text").join(chosen, "doc_id"), "toxicity-sample")
    lexicon = _lexicon(rows)
    by_fold = spark.sparkContext.broadcast([lexicon.weights(fold) for fold in range(FOLDS)])

    def numbers(batches):
        for batch in batches:
            made = [features(text, by_fold.value[fold])
                    for text, fold in zip(batch["text"], batch["fold"])]
            yield pd.DataFrame({"numbers": made, "toxic": batch["toxic"], "fold": batch["fold"]})

    found = rows.mapInPandas(numbers, "numbers array<double>, toxic int, fold int").toPandas()
    table = np.array(found["numbers"].tolist(), float).reshape(len(found), len(NAMES))
    toxic, fold = found["toxic"].to_numpy(float) > 0, found["fold"].to_numpy(int)
    # Sorted, so that the order rows arrive in leaves no trace in sums of doubles.
    order = np.lexsort((*table.T, toxic, fold))
    table, toxic, fold = table[order], toxic[order], fold[order]
    raw = np.zeros(len(table))
    for i in range(FOLDS):
        if (fold == i).any():
            raw[fold == i] = Trees().fit(table[fold != i], toxic[fold != i]).raw(table[fold == i])
    return Model(lexicon.weights(), Trees().fit(table, toxic), Isotonic().fit(raw, toxic))


def _score_column(spark, model):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts))

    return score


def score_documents(docs, labels, sample=SAMPLE):
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    score = _score_column(docs.sparkSession, fit(docs, labels, sample))
    scored = docs.select("doc_id", held_out(F.col("doc_id"), 5).alias("held_out"),
                         score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs, labels, sample=SAMPLE):
    """The rows that are not predicted toxic, with every column of ``docs``."""
    score = _score_column(docs.sparkSession, fit(docs, labels, sample))
    rows = docs.select(F.struct("*").alias("row"), score("text").alias("score"))
    return rows.filter("score < 0.5").select("row.*")
