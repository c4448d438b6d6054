"""The registered queries of the operators: whole tables, production parameters, digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wordmill.llm import (
    bpe,
    collocations,
    counts,
    decontam,
    html,
    idcoder,
    jaccard,
    lattice,
    middle,
    passages,
    quality,
    repeats,
    secrets,
)
from wordmill.llm.common import scratch, table

#: Vocabulary of the token queries; the operators take the path as a parameter.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

#: Subword pieces and their scores.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main texts of all pages."""
    pages = table(spark, folder, "pages")
    return html.extract(pages, html.fit(pages))


def op2_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents whose shingle sets link."""
    return jaccard.join(table(spark, folder, "documents"))


def op3_idcoder(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written to files and read from them again."""
    files = scratch(spark)
    idcoder.write(table(spark, folder, "documents"), files, BYTE_BPE)
    return idcoder.digests(spark, files)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Rule counts and verdicts of all documents; the forest is fitted on labelled rows."""
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, folder, "labels")))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded texts of all documents, as counts and digests."""
    return bpe.digests(table(spark, folder, "documents"), BYTE_BPE)


def op6_chaining(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of all documents that recur from an earlier one, exactly or with changes."""
    return passages.find(table(spark, folder, "documents"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents; the field is trained on windows of a sample of them."""
    docs = table(spark, folder, "documents")
    return secrets.digests(docs, secrets.fit(docs))


def op8_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents under a lattice of subword pieces."""
    return lattice.score(table(spark, folder, "documents"), PIECES)


def op9_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """What repeated strings of 100 bytes leave of all documents."""
    return repeats.remove(table(spark, folder, "documents"), digest=True)


def op10_decontam(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents that lie in windows of the benchmark."""
    return decontam.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut and arranged by a piece table, and rebuilt from the outputs."""
    return middle.digests(table(spark, folder, "documents"))


def op12_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents, counted by joins."""
    return counts.count(table(spark, folder, "documents"), PIECES)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first phrases of every language of all documents."""
    return collocations.mine(table(spark, folder, "documents"))


QUERIES = {
    "op1_html": op1_html,
    "op2_jaccard": op2_jaccard,
    "op3_idcoder": op3_idcoder,
    "op4_quality": op4_quality,
    "op5_bpe": op5_bpe,
    "op6_chaining": op6_chaining,
    "op7_secrets": op7_secrets,
    "op8_lattice": op8_lattice,
    "op9_suffix": op9_suffix,
    "op10_decontam": op10_decontam,
    "op11_middle": op11_middle,
    "op12_counts": op12_counts,
    "op13_collocations": op13_collocations,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: DuckDB SQL with the same rows. The other operators fit models, tokenize or sort suffixes,
#: which SQL cannot express; tests hold them against plain code.
ORACLE = {
    "op2_jaccard": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce({_LOWER}, ''), '[\\x20\\x09-\\x0D]+'),
                lambda x: x <> '') AS ws FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3),
                    lambda i: array_to_string(ws[i:i + 4], ' ')))
                WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w
        ), one AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
        pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b FROM one x JOIN one y ON x.g = y.g AND x.doc_id <> y.doc_id
            GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
        ), r AS (SELECT doc_id AS d, doc_id AS m FROM s UNION SELECT pairs.b, r.m FROM r JOIN pairs ON pairs.a = r.d)
        SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(r.m) AS component_id
        FROM s JOIN r ON r.d = s.doc_id GROUP BY s.doc_id, sh""",
    "op10_decontam": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
            FROM documents
        ), i AS (
            SELECT item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
            FROM benchmark
        ), iw AS (
            SELECT DISTINCT item_id, k, array_to_string(ws[p:p + k - 1], ' ') AS g FROM (
                SELECT item_id, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p
                FROM i WHERE len(ws) > 0)
        ), dw AS (
            SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS g FROM (
                SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p
                FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k)
        ), m AS (SELECT doc_id, p, dw.k, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.k = iw.k),
        h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY 1),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY 1)
        SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
        FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id""",
    "op11_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
        ), u AS (
            SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us,
                CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
        ), c AS (
            SELECT doc_id, t, us, len(us) AS n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
        ), p AS (
            SELECT doc_id, t, n, form, array_to_string(us[1:a], '') AS p, array_to_string(us[a + 1:b], '') AS m,
                array_to_string(us[b + 1:], '') AS s FROM c
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
        FROM p""",
    "op13_collocations": rf"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents WHERE text IS NOT NULL
        ), w AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
        ), grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS g
            FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(ws) >= k
        ), f AS (
            SELECT lang, k, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f FROM grams GROUP BY lang, k, phrase
        ), n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
        often AS MATERIALIZED (SELECT * FROM f WHERE f >= 10),
        parts AS MATERIALIZED (
            SELECT lang, k, phrase, f AS a, cut, array_to_string(g[1:cut], ' ') AS first, array_to_string(g[cut + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k > 1)
        ), cuts AS (
            SELECT p.lang, p.k, p.phrase, a, l.f AS l, r.f AS r, cut,
                CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
            FROM parts AS p JOIN often AS l ON l.lang = p.lang AND l.phrase = p.first
                JOIN often AS r ON r.lang = p.lang AND r.phrase = p.rest
        ), c AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (
            SELECT lang, phrase, max(a) AS f FROM (
                SELECT lang, rest AS phrase, a FROM parts WHERE k = 3 AND cut = 1
                UNION ALL SELECT lang, first, a FROM parts WHERE k = 3 AND cut = 2) GROUP BY lang, phrase
        ), alone AS (
            SELECT c.* FROM c LEFT JOIN longer ON longer.lang = c.lang AND longer.phrase = c.phrase
            WHERE longer.f IS NULL OR 100 * longer.f < 50 * c.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
            CAST(n.n AS BIGINT) AS n, score
        FROM alone JOIN n USING (lang) QUALIFY rank <= 2000""",
}
