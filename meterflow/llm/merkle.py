"""Document fingerprints: a Merkle tree over word runs, paragraphs and sections, in DataFrame
functions.

Paragraphs are the lines of a text. Content cuts them into their leaves: a run of words ends with
a word whose MD5 begins with 0 to 3, or after eight words; so a word put in or taken out moves the
borders next to it and no others. Likewise a section ends with a paragraph whose digest begins
with 0 or 1. A leaf's node is the SHA-256 of its characters, white space included; a paragraph's
that of its leaves' nodes, a section's that of its paragraphs' nodes, and the root's, the
fingerprint, that of the sections' nodes. Roots test equality. Two trees are compared from the top:
equal roots are alike whatever is below; sections that both have are equal, and the paragraphs
of the others locate the edit. Likeness is twice the leaves that both trees have over the leaves of
each, repeated ones as often as both repeat them. A section or paragraph that both trees have adds
its leaves to both sides, so that counting from the leaves gives what the descent gives.

Defined cases: null counts as the empty text, which has one empty paragraph. Two texts of empty
paragraphs alone have likeness 1, one of them and another text 0. The next document has the next smaller
``doc_id``, a null id being the smallest, and the last one's next is the first. Rows that share
an id share the next document; if several rows have the id that is next, the one that is first
by its text counts. A single document is its own next. An empty table gives no rows. Other
columns may have any name.
"""

from pyspark.sql import functions as F

from meterflow.llm.common import ranked
from meterflow.session import written

TOKEN = r"[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*|[\x20\x09\x0B-\x0D]+"
LEAF = r"[\x20\x09\x0B-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,8}|[\x20\x09\x0B-\x0D]+"
LAST = r"(?<= [01][0-9a-f]{63}) "


def leaves(line):
    """The runs of words of a line, which together are the line."""
    def marked(token):
        return F.when(F.md5(token) < "4", F.concat(token, F.lit("\n"))).otherwise(token)

    words = F.transform(F.regexp_extract_all(line, F.lit(TOKEN), 0), marked)
    runs = F.split(F.array_join(words, ""), "\n")
    return F.flatten(F.transform(runs, lambda run: F.regexp_extract_all(run, F.lit(LEAF), 0)))


def bound(value, use):
    """``use`` of a column that is evaluated once, however often it stands in the result."""
    return F.transform(F.array(value), use)[0]


def numbered(found):
    """A number for each leaf of a flat array: equal ones count on from 1, so that a set of numbers
    is a set of leaves with their repeats. Sorted, so in time little above the number of leaves."""
    def runs(ordered):
        """Where each run of equal numbers begins, and where the last one ends."""
        shifted = F.concat(F.array(F.lit(None).cast("long")), ordered)
        last = F.concat(ordered, F.array(F.lit(None).cast("long")))
        same = F.zip_with(shifted, last, lambda a, b: a.eqNullSafe(b))
        return F.filter(F.transform(same, lambda s, i: F.when(~s, i)), lambda i: i.isNotNull())

    def count(ordered):
        return bound(runs(ordered), lambda begins: F.zip_with(
            begins, F.slice(begins, F.lit(2), F.size(begins)), lambda a, b: b - a))

    def each(ordered):
        return F.flatten(F.zip_with(F.array_distinct(ordered), F.filter(
            count(ordered), lambda n: n.isNotNull()), lambda leaf, n: F.transform(
                F.sequence(F.lit(1), n), lambda k: F.xxhash64(leaf, k))))

    hashes = F.array_sort(F.transform(found, lambda leaf: F.xxhash64(leaf)))
    return bound(hashes, lambda ordered: F.when(
        F.size(ordered) == 0, F.array().cast("array<bigint>")).otherwise(each(ordered)))


def add_tree(rows, text, prefix):
    """``rows`` with the columns ``<prefix>paragraphs``, ``<prefix>sections``, ``<prefix>root``:
    digests of the nodes of each level, in the order of the text; and ``<prefix>leaves``, the
    numbered leaves."""
    paragraphs, sections = f"{prefix}paragraphs", f"{prefix}sections"
    rows = rows.withColumn(f"{prefix}lines", F.transform(F.split(text, "\n"), leaves))
    rows = rows.withColumn(paragraphs, F.transform(f"{prefix}lines", lambda line: F.sha2(
        F.array_join(F.transform(line, lambda leaf: F.sha2(leaf, 256)), " "), 256)))
    line = F.concat(F.lit(" "), F.array_join(paragraphs, " "))
    rows = rows.withColumn(
        sections,
        F.transform(F.split(line, LAST), lambda part: F.sha2(F.ltrim(part), 256)),
    )
    rows = rows.withColumn(f"{prefix}root", F.sha2(F.array_join(sections, " "), 256))
    flat = F.flatten(F.col(f"{prefix}lines"))
    return rows.withColumn(f"{prefix}leaves", numbered(flat)).drop(f"{prefix}lines")


def likeness(own, other, same):
    """0 to 1: the share of leaves that two trees have in common; 1 where the roots are the
    ``same``."""
    total = F.size(own) + F.size(other)
    both = F.size(F.array_intersect(own, other))
    return F.when(same | (total == 0), F.lit(1.0)).otherwise(F.lit(2.0) * both / total)


def first_change(paragraphs, other):
    """Number, from 1, of the first paragraph that differs; 0 if none does."""
    differs = F.zip_with(paragraphs, other, lambda a, b: ~a.eqNullSafe(b))
    return F.array_position(differs, True)


def changed_sections(sections, other):
    """How many different sections the other text does not have."""
    return F.size(F.array_except(sections, other))


def _asks(texts):
    """For each id, the id whose next document it is, and how many code points that one needs."""
    half = F.floor(F.char_length("text") / 2).alias("half")
    ids = texts.select("doc_id", half).groupBy("doc_id").agg(F.max("half").alias("half"))
    placed = written(ranked(ids, F.col("doc_id").desc_nulls_last()), "merkle-places")
    number = placed.count()
    askers = placed.select(
        F.col("doc_id").alias("asker"), "half",
        ((F.col("rank") + 1) % F.lit(max(1, number))).alias("rank"),
    )
    return written(placed.drop("half").join(askers, "rank").drop("rank"), "merkle-asks"), number


def with_next(docs):
    """``doc_id``, ``text``, the first half length of the next document's text in ``head``, and
    its numbered leaves in ``next_leaves``.

    Texts are dealt by id once, for both joins, and only what is asked for goes on from there.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    asks, number = _asks(texts)
    asks = asks.withColumnRenamed("doc_id", "id").hint("merge")
    heads = texts.join(asks, F.col("doc_id").eqNullSafe(F.col("id"))).select(
        "asker", F.substring("text", F.lit(1), F.col("half").cast("int")).alias("head"),
        numbered(F.flatten(F.transform(F.split("text", "\n"), leaves))).alias("next_leaves"),
    )
    if texts.count() > number:
        heads = heads.groupBy("asker").agg(
            F.min(F.struct("head", "next_leaves")).alias("first")
        ).select("asker", "first.*")
    joined = texts.join(heads.hint("merge"), F.col("doc_id").eqNullSafe(F.col("asker")))
    return joined.drop("asker")


def fingerprints(docs):
    """One row per document: ``doc_id``, ``fingerprint`` and ``n_chars``."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return add_tree(texts, F.col("text"), "").select(
        "doc_id", F.col("root").alias("fingerprint"),
        F.char_length("text").cast("long").alias("n_chars"),
    )


def edited_fingerprints(docs):
    """Fingerprints of every text and of its edited text, whose second half is the beginning of
    the next document, with likenesses and the place of the edit."""
    rows = with_next(docs).withColumn("n_chars", F.char_length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars") - half),
        F.substring("head", F.lit(1), half),
    )
    rows = rows.withColumn("edited", edited).drop("head")
    rows = add_tree(add_tree(rows, F.col("text"), ""), F.col("edited"), "edited_")
    own, same = F.col("leaves"), F.col("root") == F.col("edited_root")
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("root").alias("fingerprint"), F.col("edited_root").alias("edited_fingerprint"),
        likeness(own, F.col("edited_leaves"), same).alias("near_edited"),
        likeness(own, F.col("next_leaves"), F.lit(False)).alias("near_next"),
        first_change(F.col("paragraphs"), F.col("edited_paragraphs")).alias("first_change"),
        changed_sections(F.col("sections"), F.col("edited_sections")).alias("changed_sections"),
    )
