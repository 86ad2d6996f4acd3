"""The operators over whole tables, and SQL for those that SQL can express."""

import public_tokenizers

from meterflow.llm import (
    bpe,
    byte_bpe,
    exact_dedup,
    html_extract,
    license_scan,
    lm_score,
    merkle,
    mixing,
    secrets_scan,
    simhash,
    toxicity,
    turns,
    whitening,
)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def mix_sources(spark, sf_dir):
    mixed = mixing.mix_counts(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def licenses(spark, sf_dir):
    return license_scan.scan_documents(documents(spark, sf_dir))


def exact(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def near(spark, sf_dir):
    return simhash.near_groups(documents(spark, sf_dir))


def scored(spark, sf_dir):
    return lm_score.score_documents(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def fingerprints(spark, sf_dir):
    return merkle.edited_fingerprints(documents(spark, sf_dir))


def secrets(spark, sf_dir):
    return secrets_scan.scan_documents(documents(spark, sf_dir))


def pages(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def encoded(spark, sf_dir):
    return bpe.encode_digests(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")
    )


def whitened(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def conversations(spark, sf_dir):
    return turns.repair(table(spark, sf_dir, "conversations"))


def byte_encoded(spark, sf_dir):
    return byte_bpe.encode_digests(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def toxic(spark, sf_dir):
    return toxicity.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_mix_sources": mix_sources,
    "op2_simhash": near,
    "op3_licenses": licenses,
    "op4_exact_dedup": exact,
    "op5_lm_score": scored,
    "op6_merkle": fingerprints,
    "op7_secrets": secrets,
    "op8_html": pages,
    "op9_bpe": encoded,
    "op10_toxicity": toxic,
    "op11_whitening": whitened,
    "op12_conversations": conversations,
    "op13_byte_bpe": byte_encoded,
}

LOWER = """translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz')"""

SPACE, SOLID = r"[\x20\x09\x0B-\x0D]", r"[^\x20\x09-\x0D]"


def _leaves(line):
    """The runs of words of a line: cut behind words by their MD5, and after eight."""
    words = f"""list_transform(regexp_extract_all({line}, '{SOLID}+{SPACE}*|{SPACE}+'),
      lambda word: CASE WHEN md5(word) < '4' THEN word || chr(10) ELSE word END)"""
    return f"""flatten(list_transform(
      string_split(coalesce(list_aggregate({words}, 'string_agg', ''), ''), chr(10)),
      lambda run: regexp_extract_all(run, '{SPACE}*(?:{SOLID}+{SPACE}*){{1,8}}|{SPACE}+')))"""


def _roots(texts, text):
    """doc_id, leaves, paragraphs, sections and root of each text."""
    return f"""
      SELECT doc_id, flatten(list(nodes ORDER BY part)) AS paragraphs,
        list(section ORDER BY part) AS sections,
        sha256(string_agg(section, ' ' ORDER BY part)) AS root
      FROM (
        SELECT doc_id, part, list(node ORDER BY place) AS nodes,
          sha256(string_agg(node, ' ' ORDER BY place)) AS section
        FROM (
          SELECT *, coalesce(sum((node[1] IN ('0', '1'))::INT) OVER (PARTITION BY doc_id
            ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part
          FROM (
            SELECT doc_id, unnest(lines) AS node, generate_subscripts(lines, 1) AS place
            FROM (SELECT doc_id, list_transform(string_split({text}, chr(10)),
                    lambda line: sha256(array_to_string(list_transform({_leaves('line')},
                      lambda leaf: sha256(leaf)), ' '))) AS lines FROM {texts})))
        GROUP BY doc_id, part)
      GROUP BY doc_id"""


def _counts(texts, text):
    """How often each leaf occurs in each text."""
    return f"""
      SELECT doc_id, leaf, count(*) AS n
      FROM (SELECT doc_id, unnest({_leaves('line')}) AS leaf
        FROM (SELECT doc_id, unnest(string_split({text}, chr(10))) AS line FROM {texts}))
      GROUP BY doc_id, leaf"""


def _likeness(a, b):
    return f"""
      SELECT doc_id, CASE WHEN coalesce(p.n, 0) + coalesce(q.n, 0) = 0 THEN 1.0::DOUBLE
        ELSE 2.0::DOUBLE * coalesce(r.n, 0) / (coalesce(p.n, 0) + coalesce(q.n, 0)) END AS near
      FROM edits
      LEFT JOIN (SELECT doc_id, sum(n) AS n FROM {a} GROUP BY doc_id) p USING (doc_id)
      LEFT JOIN (SELECT doc_id, sum(n) AS n FROM {b} GROUP BY doc_id) q USING (doc_id)
      LEFT JOIN (SELECT doc_id, sum(least({a}.n, {b}.n)) AS n FROM {a} JOIN {b}
        USING (doc_id, leaf) GROUP BY doc_id) r USING (doc_id)"""


ORACLE = {
    "op1_mix_sources": r"""
      WITH sizes AS (
        SELECT doc_id, source,
          coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
          coalesce(doc_id::VARCHAR, md5(md5(text)), '') AS name
        FROM documents),
      sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
          [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
            (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
        FROM sizes GROUP BY source),
      total AS (
        SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS words, sum(weight) AS weight
        FROM sources),
      prefixes AS (
        SELECT
          coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE AS taken,
          coalesce(sum(weight) OVER before, 0)::DOUBLE AS weight
        FROM sources
        WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      best AS (
        SELECT max((t.words - p.taken) / (t.weight - p.weight)) AS per_weight
        FROM prefixes p, total t),
      targets AS (
        SELECT source, source_size,
          least(2.0::DOUBLE * source_size, weight * per_weight) AS target
        FROM sources, best),
      rates AS (
        SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
        FROM targets),
      drawn AS (
        SELECT doc_id, size, source_size, target, rate,
          ('0x' || substr(md5('mix:' || name), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
        FROM sizes JOIN rates ON sizes.source IS NOT DISTINCT FROM rates.source)
      SELECT doc_id, size, source_size, target,
        (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken
      FROM drawn""",
    "op6_merkle": f"""
      WITH plain AS (
        SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
          length(coalesce(text, '')) // 2 AS half
        FROM documents),
      following AS (
        SELECT *, coalesce(lead(text) OVER by_id, first(text) OVER by_id) AS following
        FROM plain WINDOW by_id AS (ORDER BY doc_id DESC
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
      edits AS (
        SELECT *, left(text, n - half) || left(following, half) AS edited FROM following),
      own AS ({_roots('edits', 'text')}),
      other AS ({_roots('edits', 'edited')}),
      a AS ({_counts('edits', 'text')}),
      b AS ({_counts('edits', 'edited')}),
      c AS ({_counts('edits', 'following')}),
      near_edited AS ({_likeness('a', 'b')}),
      near_next AS ({_likeness('a', 'c')})
      SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
        own.root AS fingerprint, other.root AS edited_fingerprint,
        near_edited.near AS near_edited, near_next.near AS near_next,
        coalesce(list_position(list_transform(
          range(1, greatest(len(own.paragraphs), len(other.paragraphs)) + 1),
          lambda i: own.paragraphs[i] IS DISTINCT FROM other.paragraphs[i]), true), 0)::BIGINT
          AS first_change,
        len(list_filter(list_distinct(own.sections),
          lambda s: NOT list_contains(other.sections, s)))::INT AS changed_sections
      FROM edits JOIN own USING (doc_id) JOIN other USING (doc_id)
        JOIN near_edited USING (doc_id) JOIN near_next USING (doc_id)""",
    "op4_exact_dedup": f"""
      WITH plain AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents),
      grouped AS (
        SELECT *, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
        FROM plain WINDOW same AS (PARTITION BY text_sha256))
      SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
      FROM grouped""",
}
