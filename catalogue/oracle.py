"""The same answers in DuckDB SQL, computed from the tables without an index."""

from __future__ import annotations

from wordmill.functions.chains import ENGLISH_STOP, GAP, TOKEN
from wordmill.functions.folding import MULTI_LETTER, SINGLE_LETTER
from wordmill.functions.stemming import STEP_2, STEP_3, STEP_4

PATTERN = "'" + TOKEN.replace("'", "''") + "'"
PIECES = "'" + f"{TOKEN}|{GAP}".replace("'", "''") + "'"

TEXTS = {
    "text": "text",
    "head": "split_part(text, chr(10), 1)",
    "_all": "concat_ws(' ', text, lang, source, n_chars)",
}


def tokens(text="lower(text)", source="documents", key="doc_id", extra="") -> str:
    """Rows of key, position and token of a text."""
    return (
        f"SELECT {key}{extra}, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS position "
        f"FROM (SELECT *, regexp_extract_all({text}, {PATTERN}) AS t FROM {source})"
    )


def folded(text: str) -> str:
    for letter, spelled in {**MULTI_LETTER, **SINGLE_LETTER}.items():
        text = f"replace({text}, '{letter}', '{spelled}')"
    return f"strip_accents({text})"


def words(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# ---- stemmers ------------------------------------------------------------------------

C = "[^aeiou][^aeiouy]*"
V = "[aeiouy][aeiou]*"


def over_0(x):
    return f"regexp_matches({x}, '^({C})?{V}{C}')"


def over_1(x):
    return f"regexp_matches({x}, '^({C})?{V}{C}{V}{C}')"


def is_1(x):
    return f"regexp_matches({x}, '^({C})?{V}{C}({V})?$')"


def vowel(x):
    return f"regexp_matches({x}, '^({C})?[aeiouy]')"


def short(x):
    return f"regexp_matches({x}, '^{C}[aeiouy][^aeiouwxy]$')"


def cut(x, n):
    return f"left({x}, length({x}) - {n})"


def ending(*suffixes):
    """Longest suffix `e` and stem `s`, beside the other columns."""
    found = f"regexp_extract(w, '({'|'.join(suffixes)})$', 1)"
    return f"*, {found} AS e, left(w, length(w) - length({found})) AS s"


def swap(table):
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items())
    return f"CASE WHEN e <> '' AND {over_0('s')} THEN s || CASE e {cases} END ELSE w END"


def porter(source: str) -> str:
    """`term` and `stem` for a query with a column `term`."""
    doubles = "|".join(letter * 2 for letter in "bcdfghjkmnpqrtvwx")
    steps = [
        f"SELECT term, regexp_replace(CASE WHEN term[1] = 'y' THEN 'Y' || term[2:] ELSE term END, "
        f"'(?:(ss|i)es|([^s])s)$', '\\1\\2') AS w FROM ({source})",
        f"SELECT {ending('eed', 'ed', 'ing')} FROM (%s)",
        f"SELECT term, e IN ('ed', 'ing') AND {vowel('s')} AS removed, "
        f"CASE WHEN e IN ('ed', 'ing') AND {vowel('s')} THEN s "
        f"WHEN e = 'eed' AND {over_0('s')} THEN s || 'ee' ELSE w END AS w FROM (%s)",
        f"SELECT term, CASE WHEN NOT removed THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e' "
        f"WHEN regexp_matches(w, '({doubles})$') THEN {cut('w', 1)} "
        f"WHEN {is_1('w')} AND {short('w')} THEN w || 'e' ELSE w END AS w FROM (%s)",
        f"SELECT term, CASE WHEN w LIKE '%%y' AND {vowel(cut('w', 1))} THEN {cut('w', 1)} || 'i' ELSE w END AS w "
        "FROM (%s)",
        f"SELECT {ending(*STEP_2)} FROM (%s)",
        f"SELECT term, {swap(STEP_2)} AS w FROM (%s)",
        f"SELECT {ending(*STEP_3)} FROM (%s)",
        f"SELECT term, {swap(STEP_3)} AS w FROM (%s)",
        f"SELECT {ending(*STEP_4)} FROM (%s)",
        f"SELECT term, CASE WHEN e <> '' AND {over_1('s')} AND (e <> 'ion' OR regexp_matches(s, '[st]$')) "
        "THEN s ELSE w END AS w FROM (%s)",
        f"SELECT term, CASE WHEN w LIKE '%%e' AND ({over_1(cut('w', 1))} OR "
        f"({is_1(cut('w', 1))} AND NOT {short(cut('w', 1))})) THEN {cut('w', 1)} ELSE w END AS w FROM (%s)",
        f"SELECT term, CASE WHEN w LIKE '%%ll' AND {over_1('w')} THEN {cut('w', 1)} ELSE w END AS w FROM (%s)",
        "SELECT term, CASE WHEN length(term) <= 2 THEN term WHEN term[1] = 'y' THEN 'y' || w[2:] "
        "ELSE w END AS stem FROM (%s)",
    ]
    sql = steps[0]
    for step in steps[1:]:
        sql = step.replace("(%s)", f"({sql})").replace("%%", "%")
    return sql


LIGHT = (
    f"CASE WHEN length(token) < 3 THEN token "
    f"WHEN token LIKE '%ies' AND NOT regexp_matches(token, '[ae]ies$') THEN {cut('token', 3)} || 'y' "
    f"WHEN token LIKE '%es' AND NOT regexp_matches(token, '[aeo]es$') THEN {cut('token', 1)} "
    f"WHEN token LIKE '%s' AND NOT regexp_matches(token, '[us]s$') THEN {cut('token', 1)} "
    "ELSE token END"
)

# The sample chain, stage by stage: folded, overridden, protected.
FOLDED = f"SELECT doc_id, position, token AS plain, lower(token) AS low, {folded('lower(token)')} AS fold FROM ({tokens('text')})"
OVERRIDE = (
    "CASE fold WHEN 'ties' THEN 'tie' WHEN 'were' THEN 'was' WHEN 'eres' THEN 'er' WHEN 'das' THEN 'the' ELSE fold END"
)
SAMPLE = (
    f"WITH c AS (SELECT *, {OVERRIDE} AS over, fold IN ('thing', 'disgusting', 'ties', 'were', 'eres', 'das') AS kept "
    f"FROM ({FOLDED})), stems AS ({porter('SELECT DISTINCT over AS term FROM c')}), "
    "done AS (SELECT c.*, CASE WHEN kept THEN over ELSE stem END AS final, "
    "over NOT IN ('a', 'is', 'the', 'was') AS stays FROM c JOIN stems ON over = term)"
)


def stages() -> str:
    rows = [
        (0, "standard", "plain", ""),
        (1, "lowercase", "low", ""),
        (2, "asciifolding", "fold", ""),
        (3, "keyword_marker", "fold", ""),
        (4, "stemmer_override", "over", ""),
        (5, "stop", "over", " WHERE stays"),
        (6, "porter_stem", "final", " WHERE stays"),
    ]
    parts = [
        f"SELECT CAST({n} AS BIGINT) AS stage_no, '{name}' AS stage, {column} AS token, "
        f"count(*) AS tokens, CAST(sum(position) AS BIGINT) AS positions FROM done{where} GROUP BY {column}"
        for n, name, column, where in rows
    ]
    return f"{SAMPLE} " + " UNION ALL ".join(parts)


ENGLISH = (
    f"WITH c AS (SELECT doc_id, position, regexp_replace(token, '[''’][sS]$', '') AS over FROM ({tokens()})), "
    f"stems AS ({porter('SELECT DISTINCT over AS term FROM c')}) "
    f"SELECT doc_id, position, stem AS token FROM c JOIN stems ON over = term WHERE over NOT IN {words(ENGLISH_STOP)}"
)


# ---- BM25 ------------------------------------------------------------------------------


def corpus(fields=("text",), source="documents", key="doc_id") -> str:
    """Common tables: tok, post, len, st, dic."""
    tok = " UNION ALL ".join(
        f"SELECT '{f}' AS field, doc_id, token, position FROM ({tokens(f'lower({TEXTS[f]})', source, key)})"
        for f in fields
    )
    return (
        f"tok AS MATERIALIZED ({tok}), "
        "post AS MATERIALIZED (SELECT field, doc_id, token AS term, count(*) AS tf FROM tok GROUP BY ALL), "
        "len AS MATERIALIZED (SELECT field, doc_id, count(*) AS dl FROM tok GROUP BY ALL), "
        "st AS (SELECT field, count(*) AS n, avg(dl) AS avgdl FROM len GROUP BY field), "
        "dic AS MATERIALIZED (SELECT field, term, count(*) AS df, sum(tf)::BIGINT AS cf FROM post GROUP BY ALL)"
    )


IDF = "ln(1 + (n - df + 0.5) / (df + 0.5))"


def tf_norm(tf="tf"):
    return f"{tf} * 2.2 / ({tf} + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))"


SCORED = (
    f"c AS (SELECT q.*, doc_id, tf, df, dl, {IDF} AS idf, {tf_norm()} AS tf_norm, "
    f"qtf * boost * {IDF} * {tf_norm()} AS part "
    "FROM q JOIN post USING (field, term) JOIN len USING (field, doc_id) "
    "JOIN dic USING (field, term) JOIN st USING (field))"
)


def values(rows) -> str:
    body = ", ".join(f"('{slot}', '{field}', '{term}', {qtf}, {boost})" for slot, field, term, qtf, boost in rows)
    return f"q(slot, field, term, qtf, boost) AS (VALUES {body})"


def asked(fields, text, slot="m", boosts=None):
    """Query terms of a text whose words are single lower-case tokens."""
    split = text.split()
    return [
        (slot, f, term, split.count(term), (boosts or {}).get(f, 1.0)) for f in fields for term in dict.fromkeys(split)
    ]


def bm25(rows, final, source="documents", key="doc_id", more="") -> str:
    fields = tuple(dict.fromkeys(r[1] for r in rows))
    return f"WITH {corpus(fields, source, key)}, {values(rows)}, {SCORED}{more} {final}"


SUM = "SELECT doc_id, round(sum(part), 4) AS score FROM c GROUP BY doc_id"
TOP = " ORDER BY score DESC, doc_id"
THE_AND = asked(("text",), "the and")
BOTH = ("text", "head")


def over_fields(how, where="TRUE"):
    return (
        f"SELECT doc_id, round({how}(s), 4) AS score FROM "
        f"(SELECT doc_id, field, sum(part) AS s FROM c WHERE {where} GROUP BY doc_id, field) GROUP BY doc_id"
    )


MATCH_OR = bm25(THE_AND, SUM)
# Best-fields score `s` of every word and document.
WORDS = (
    ", f AS (SELECT slot, doc_id, field, sum(part) AS s FROM c GROUP BY ALL), "
    "b AS (SELECT slot, doc_id, max(s) AS s FROM f GROUP BY ALL)"
)


def best_words(*texts):
    return [row for text in texts for row in asked(BOTH, text, slot=text)]


def phrase(field, fixed, prefix, boost=1.0) -> str:
    """Documents with a phrase of one-token words, its last word a prefix."""
    joins = "".join(
        f" JOIN tok t{i} ON t{i}.field = t0.field AND t{i}.doc_id = t0.doc_id AND t{i}.position = t0.position + {i}"
        for i in range(1, len(fixed) + 1)
    )
    last = len(fixed)
    where = " AND ".join(["TRUE", *(f"t{i}.token = '{word}'" for i, word in enumerate(fixed))])
    begins = f"field = '{field}' AND starts_with(token, '{prefix}')"
    return (
        f"SELECT doc_id, {boost} * (idf_sum + {IDF}) * {tf_norm()} AS score FROM ("
        f"SELECT t0.doc_id, count(*) AS tf, (SELECT coalesce(sum({IDF}), 0) FROM "
        f"(SELECT unnest(CAST({list(fixed)!r} AS VARCHAR[])) AS term) JOIN dic USING (term) JOIN st USING (field) "
        f"WHERE field = '{field}') AS idf_sum, (SELECT count(DISTINCT doc_id) FROM tok WHERE {begins}) AS df "
        f"FROM tok t0{joins} WHERE t0.field = '{field}' AND {where} AND starts_with(t{last}.token, '{prefix}') "
        f"GROUP BY t0.doc_id) JOIN len USING (doc_id) JOIN st USING (field) WHERE field = '{field}'"
    )


WILDCARD = "SELECT DISTINCT doc_id, CAST(1.0 AS DOUBLE) AS score FROM tok WHERE token LIKE '%tion%'"

QUERY_STRING = bm25(
    best_words("the", "que", "en"),
    "SELECT doc_id, round(sum(s), 4) AS score FROM b WHERE slot IN ('the', 'que') "
    "AND doc_id NOT IN (SELECT doc_id FROM b WHERE slot = 'en') GROUP BY doc_id",
    more=WORDS,
)
SIMPLE_QUERY_STRING = bm25(
    best_words("from", "das", "la", "der"),
    "SELECT doc_id, round(CASE WHEN count(*) FILTER (slot IN ('from', 'das')) = 2 THEN sum(s) "
    "ELSE sum(s) FILTER (slot = 'la') END, 4) AS score FROM b WHERE slot <> 'der' "
    "AND doc_id NOT IN (SELECT doc_id FROM b WHERE slot = 'der') GROUP BY doc_id "
    "HAVING count(*) FILTER (slot IN ('from', 'das')) = 2 OR count(*) FILTER (slot = 'la') = 1",
    more=WORDS,
)

DISPATCHED = {
    "match": MATCH_OR,
    "best_fields": bm25(asked(BOTH, "the and"), over_fields("max")),
    "most_fields": bm25(asked(BOTH, "the and"), over_fields("sum")),
    "phrase_prefix": f"WITH {corpus()} SELECT doc_id, round(score, 4) AS score FROM ({phrase('text', ['of'], 'th')})",
    "term": bm25(asked(("text",), "of"), SUM),
    "wildcard": f"WITH {corpus()} {WILDCARD}",
    "query_string": QUERY_STRING,
    "simple_query_string": bm25(
        best_words("the", "que"), "SELECT doc_id, round(sum(s), 4) AS score FROM b GROUP BY doc_id", more=WORDS
    ),
}

# ---- many queries ------------------------------------------------------------------------

PLAIN = r"string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')"
# Runs of all words of the passages, by the place of the first.
REQUESTS = (
    "r AS (SELECT item_id * 1000000 + place AS query_id, place, w[place + 1] AS w1, coalesce(w[place + 2], 'the') AS w2, "
    "coalesce(w[place + 3], 'the') AS w3, coalesce(w[place + 4], 'the') AS w4 "
    f"FROM (SELECT *, unnest(range(len(w))) AS place FROM (SELECT *, {PLAIN} AS w FROM benchmark)))"
)
RANKED = (
    "SELECT query_id, rank, doc_id, score FROM (SELECT *, "
    "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM h) WHERE rank <= 5"
)
# Query terms of whole passages.
PASSAGES = (
    "p AS (SELECT item_id AS query_id, token AS term, count(*) AS qtf FROM "
    f"({tokens(source='benchmark', key='item_id')}) GROUP BY ALL)"
)


def many(fields, hits, more="") -> str:
    return f"WITH {corpus(fields)}, {REQUESTS}, {PASSAGES}{more}, h AS ({hits}) {RANKED}"


PASSAGE_PARTS = (
    f"SELECT query_id, doc_id, field, sum(qtf * {IDF} * {tf_norm()}) AS s FROM p JOIN post USING (term) "
    "JOIN len USING (field, doc_id) JOIN dic USING (field, term) JOIN st USING (field) GROUP BY ALL"
)
# Best-fields scores of single words.
WORD_SCORES = (
    f", b AS (SELECT term, doc_id, max({IDF} * {tf_norm()}) AS s FROM post JOIN len USING (field, doc_id) "
    "JOIN dic USING (field, term) JOIN st USING (field) GROUP BY term, doc_id)"
)
MANY_PHRASES = (
    "WITH r2 AS (SELECT * FROM r WHERE place % 2 = 0), "
    "e AS (SELECT left(w2, 2) AS p, count(DISTINCT doc_id) AS df FROM (SELECT DISTINCT left(w2, 2) AS w2 FROM r2) "
    "JOIN tok ON starts_with(token, w2) GROUP BY ALL), "
    f"i AS (SELECT query_id, e.p, {IDF.replace('df', 'e.df')} + {IDF.replace('df', 'dic.df')} AS idf_sum "
    "FROM r2 JOIN e ON e.p = left(w2, 2) JOIN dic ON dic.term = w1 JOIN st USING (field)), "
    "o AS (SELECT query_id, a.doc_id, count(*) AS tf FROM r2 JOIN tok a ON a.token = w1 "
    "JOIN tok b ON a.doc_id = b.doc_id AND a.position = b.position - 1 AND starts_with(b.token, left(w2, 2)) GROUP BY ALL) "
    f"SELECT query_id, doc_id, round(idf_sum * {tf_norm()}, 4) AS score FROM o JOIN i USING (query_id) "
    "JOIN len USING (doc_id) JOIN st USING (field)"
)
MANY_REQUESTS = (
    "SELECT query_id, doc_id, round(sum(s), 4) AS score FROM ("
    "SELECT query_id, doc_id, term, s, term IN (w1, w2) AS req, term = w3 AS exc, "
    "(CASE WHEN w1 = w2 AND term = w1 THEN 2 ELSE CASE WHEN term IN (w1, w2) THEN 1 ELSE 0 END END "
    "+ CASE WHEN term = w4 THEN 1 ELSE 0 END) AS times FROM (SELECT DISTINCT * FROM (SELECT *, unnest([w1, w2, w3, w4]) AS term FROM r WHERE place % 4 = 0) AS r) JOIN b USING (term)) "
    "GROUP BY query_id, doc_id HAVING bool_or(req) AND NOT bool_or(exc)"
).replace("sum(s)", "sum(s * times)")

# ---- statistics and suggestions -------------------------------------------------------------


def stat(column, prefix=""):
    return (
        f"count({column}) AS {prefix}count, round(min({column}), 4) AS {prefix}min, "
        f"round(max({column}), 4) AS {prefix}max, round(avg({column}), 4) AS {prefix}avg, "
        f"round(sum({column}), 4) AS {prefix}sum"
    )


def edits(a, b):
    """Edit distance in letters. DuckDB's counts bytes, so the accented letters of the
    lower-case terms first become capitals, one byte each."""
    one = [f"translate({x}, 'éèêçàâîôûùëïäöüßñáíóú', 'ABCDEFGHIJKLMNOPQRSTU')" for x in (a, b)]
    return f"levenshtein({one[0]}, {one[1]})"


SUGGESTED = (
    f"near AS (SELECT name, m.field, token, term AS suggestion, df, {edits('token', 'term')} AS edits "
    "FROM missing m JOIN dic d ON d.field = m.field AND left(token, 1) = left(term, 1) "
    f"AND abs(length(token) - length(term)) <= 2 WHERE length(term) >= 4 AND {edits('token', 'term')} <= 2), "
    "ranked AS (SELECT *, 1 - edits / least(length(token), length(suggestion)) AS s FROM near), "
    "final AS (SELECT *, row_number() OVER (PARTITION BY name, field, token ORDER BY s DESC, df DESC, suggestion) AS rank "
    "FROM ranked)"
)


def suggested(asked_sql, fields, select="name, field, token, rank, suggestion, round(s, 4) AS score, df") -> str:
    return (
        f"WITH {corpus(fields)}, asked AS ({asked_sql}), missing AS (SELECT DISTINCT name, field, token FROM asked "
        f"WHERE NOT EXISTS (SELECT 1 FROM dic WHERE dic.field = asked.field AND dic.term = asked.token)), "
        f"{SUGGESTED} SELECT {select} FROM final WHERE rank <= 5"
    )


TURNS = "(SELECT concat_ws('-', conv_id, turn) AS doc_id, role, text FROM conversations)"

CHANGED = "(SELECT doc_id, CASE WHEN lang = 'de' THEN text || ' nachher nachher' ELSE text END AS text FROM documents)"

ORACLE: dict[str, str] = {
    "analyze_standard": tokens(),
    "analyze_folding": f"SELECT doc_id, position, {folded('lower(token)')} AS token FROM ({tokens('text')})",
    "normalize_value": f"SELECT doc_id, {folded('lower(text)')} AS folded FROM documents",
    "analyze_porter": f"SELECT term, stem FROM ({porter(f'SELECT DISTINCT token AS term FROM ({tokens()})')})",
    "analyze_light": f"SELECT doc_id, position, {LIGHT} AS token FROM ({tokens('text')})",
    "analyze_english": ENGLISH,
    "analyze_chain": f"{SAMPLE} SELECT doc_id, position, final AS token FROM done WHERE stays",
    "analyze_explain": stages(),
    "index_analyzer": tokens(source="benchmark", key="item_id"),
    "index_postings": (
        f"WITH {corpus(tuple(TEXTS))} SELECT field, token AS term, doc_id, count(*) AS tf, any_value(dl) AS dl, "
        "sum(position)::BIGINT AS positions FROM tok JOIN len USING (field, doc_id) GROUP BY field, token, doc_id"
    ),
    "index_terms": f"WITH {corpus(tuple(TEXTS))} SELECT field, term, df, cf FROM dic",
    "index_lengths": f"WITH {corpus(tuple(TEXTS))} SELECT field, doc_id, dl FROM len",
    "index_stats": (
        f"WITH {corpus(tuple(TEXTS))} SELECT field, n AS n_docs, round(avgdl, 4) AS avgdl, "
        "(SELECT count(*) FROM post WHERE post.field = st.field) AS n_postings FROM st"
    ),
    "index_upsert": (
        "SELECT doc_id, count(*) AS tokens, count(DISTINCT token) AS terms, "
        "count(*) FILTER (token = 'nachher') AS added, count(*) FILTER (token = 'vorher') AS stale "
        f"FROM ({tokens(source=CHANGED)}) GROUP BY doc_id"
    ),
    "bulk_ingest": (
        "SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice FROM part"
    ),
    "describe_index": (
        f"WITH {corpus(tuple(TEXTS))}, f(field, type, analyzer, boost) AS (VALUES "
        "('doc_id', 'bigint', NULL, NULL), ('n_chars', 'bigint', NULL, NULL), "
        "('lang', 'keyword', 'keyword', 1.0::DOUBLE), ('source', 'keyword', 'keyword', 1.0::DOUBLE), "
        "('text', 'text', 'standard', 1.0::DOUBLE), ('head', 'text', 'standard', 1.0::DOUBLE), "
        "('_all', 'text', 'standard', 1.0::DOUBLE)), "
        "n AS (SELECT field, count(*) AS n_postings FROM post GROUP BY field) "
        "SELECT field, type, analyzer, boost, n AS n_docs, n_postings "
        "FROM f LEFT JOIN st USING (field) LEFT JOIN n USING (field)"
    ),
    "create_delete": (
        "WITH k AS (SELECT count(*) AS n FROM conversations) "
        "SELECT 1::BIGINT AS step, 'create' AS action, TRUE AS acknowledged, 0::BIGINT AS documents "
        "UNION ALL SELECT 2, 'create again', FALSE, 0 UNION ALL SELECT 3, 'index nothing', FALSE, 0 "
        "UNION ALL SELECT 4, 'index', TRUE, n FROM k UNION ALL SELECT 5, 'delete', TRUE, NULL "
        "UNION ALL SELECT 6, 'delete again', FALSE, NULL"
    ),
    "match_or": MATCH_OR + TOP + " LIMIT 50",
    "match_hits": MATCH_OR,
    "match_and": MATCH_OR + " HAVING count(*) = 2",
    "multi_best": DISPATCHED["best_fields"],
    "multi_most": DISPATCHED["most_fields"],
    "multi_boost": bm25(asked(BOTH, "the and", boosts={"head": 3.0}), over_fields("max")),
    "all_field": bm25(asked(("_all",), "src3 de the"), SUM),
    "phrase_prefix": DISPATCHED["phrase_prefix"],
    "phrase_prefix_fields": (
        f"WITH {corpus(BOTH)} SELECT doc_id, round(max(score), 4) AS score FROM ("
        f"{phrase('text', ['is', 'the'], 'a')} UNION ALL {phrase('head', ['is', 'the'], 'a', 2.0)}) GROUP BY doc_id"
    ),
    "phrase_prefix_word": f"WITH {corpus()} SELECT doc_id, round(score, 4) AS score FROM ({phrase('text', [], 'thi')})",
    "phrase_prefix_first": (
        f"WITH {corpus()}, x AS (SELECT doc_id, count(*) AS tf, count(*) OVER () AS df FROM tok WHERE token IN "
        "(SELECT term FROM dic WHERE starts_with(term, 'thi') ORDER BY term LIMIT 20) GROUP BY doc_id) "
        f"SELECT doc_id, round({IDF} * {tf_norm()}, 4) AS score FROM x JOIN len USING (doc_id) JOIN st USING (field)"
    ),
    "match_array": (
        "WITH t AS (SELECT p_partkey AS doc_id, unnest(string_split(p_name, ' ')) AS term FROM part), "
        "p AS (SELECT doc_id, lower(term) AS term, count(*) AS tf FROM t GROUP BY ALL), "
        "l AS (SELECT doc_id, count(*) AS dl FROM t GROUP BY ALL), "
        "s AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM l), "
        "d AS (SELECT term, count(*) AS df FROM p GROUP BY ALL) "
        f"SELECT doc_id, round(sum({IDF} * {tf_norm()}), 4) AS score FROM p JOIN d USING (term) JOIN l USING (doc_id), s "
        "WHERE term IN ('small', 'gear') GROUP BY doc_id"
    ),
    "terms_all": "SELECT o_custkey AS key, count(*) AS doc_count FROM orders WHERE o_custkey IS NOT NULL GROUP BY ALL",
    "query_string": QUERY_STRING,
    "simple_query_string": SIMPLE_QUERY_STRING,
    "uri_query": bm25(
        asked(("_all",), "the"),
        "SELECT doc_id, round(sum(part), 4) AS score FROM (SELECT doc_id, part FROM c UNION ALL "
        "SELECT doc_id, 1.0 FROM documents WHERE source = 'src0') GROUP BY doc_id",
    ),
    "wildcard": DISPATCHED["wildcard"],
    "term_keyword": "SELECT doc_id, CAST(1.0 AS DOUBLE) AS score FROM documents WHERE lang = 'en'",
    "term_text": DISPATCHED["term"],
    "bool_query": bm25(
        asked(("text",), "the", "must") + asked(("text",), "rest", "should"),
        "SELECT doc_id, round(sum(part), 4) AS score FROM c "
        "WHERE doc_id NOT IN (SELECT doc_id FROM tok WHERE token = 'en') "
        "GROUP BY doc_id HAVING bool_or(slot = 'must')",
    ),
    "bool_column": bm25(
        asked(("text",), "the"),
        "SELECT doc_id, round(part, 4) AS score FROM c JOIN documents USING (doc_id) WHERE lang <> 'en'",
    ),
    "bool_should": (
        f"WITH {corpus(BOTH)}, {values(asked(BOTH, 'der'))}, {SCORED}, x AS (SELECT doc_id, max(part) AS s FROM c GROUP BY doc_id "
        "UNION ALL SELECT doc_id, 1.0 FROM documents WHERE source = 'src1' "
        "UNION ALL SELECT DISTINCT doc_id, 1.0 FROM tok WHERE field = 'text' AND token LIKE '%ungen%'), "
        f"without AS ({phrase('text', ['der'], 'an')}) "
        "SELECT doc_id, round(sum(s), 4) AS score FROM x WHERE doc_id NOT IN (SELECT doc_id FROM without) GROUP BY doc_id"
    ),
    "explain": bm25(
        [(s, f, t, q, 2.0 if f == "head" else b) for s, f, t, q, b in asked(BOTH, "the and and")],
        "SELECT doc_id, field, term, tf, df, dl, round(idf, 4) AS idf, round(tf_norm, 4) AS tf_norm, "
        "round(boost, 4)::DOUBLE AS boost, round(part, 4) AS contribution FROM c",
    ),
    "explain_bool": bm25(
        asked(("text",), "the and", slot="must 0") + asked(("head",), "the", slot="should 0") + asked(("text",), "of", slot="no"),
        "SELECT doc_id, slot AS clause, field, term, round(part, 4) AS contribution FROM c WHERE slot <> 'no' "
        "AND doc_id IN (SELECT doc_id FROM c WHERE slot = 'must 0') AND doc_id NOT IN (SELECT doc_id FROM c WHERE slot = 'no')",
    ),
    "min_score": f"SELECT * FROM ({MATCH_OR}) WHERE score >= 1.5{TOP} LIMIT 100",
    "match_all": "SELECT doc_id, CAST(1.0 AS DOUBLE) AS score FROM documents",
    "totals": (
        "SELECT count(*) AS total, max(score) AS max_score, round(sum(score), 2) AS sum_score "
        f"FROM ({bm25(THE_AND, 'SELECT doc_id, sum(part) AS score FROM c GROUP BY doc_id')})"
    ).replace("max(score)", "round(max(score), 4)"),
    "page_2": MATCH_OR + TOP + " LIMIT 10 OFFSET 10",
    "norm_score": (
        f"SELECT doc_id, score, round(score / (1 + max(score) OVER ()), 4) AS norm_score FROM ({MATCH_OR}){TOP} LIMIT 50"
    ),
    "extract": (
        f"SELECT score AS hit_score, source AS document_id, doc_id AS entry_id FROM ({MATCH_OR}) "
        "JOIN documents USING (doc_id) WHERE score >= 1.0"
    ),
    "extract_scores": (
        f"SELECT max(score) AS max_score, round(sum(score) FILTER (score >= 1.0), 2) AS sum_score FROM ({MATCH_OR})"
    ),
    "source_filter": (
        f"SELECT doc_id, score, lang, text FROM ({MATCH_OR}) JOIN documents USING (doc_id){TOP} LIMIT 10"
    ),
    "hit_shape": (
        "SELECT doc_id, CASE WHEN length(text) > 80 THEN left(replace(text, chr(10), ' '), 80) || '...' "
        "ELSE replace(text, chr(10), ' ') END AS shown, split_part(text, chr(10), 1) AS line, "
        "'/documents/' || lang || '/' || doc_id AS path FROM documents"
    ),
    "highlight": (
        "SELECT doc_id, array_to_string(list_transform(t, lambda x: CASE WHEN lower(x) IN ('the', 'and') "
        "THEN '<em>' || x || '</em>' ELSE x END), '') AS highlight FROM (SELECT doc_id, "
        f"regexp_extract_all(text, {PIECES}) AS t FROM documents) "
        "WHERE list_has_any(list_transform(t, lambda x: lower(x)), ['the', 'and'])"
    ),
    "date_fallback": (
        "SELECT o_orderkey, strftime(coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END, "
        "CASE WHEN o_orderpriority <> '5-LOW' THEN TIMESTAMP '1999-12-31 08:00:00' END), '%Y-%m-%d') AS shown FROM orders"
    ),
    "latest": (
        "SELECT o_orderkey, CAST(1.0 AS DOUBLE) AS score, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT' "
        "ORDER BY o_orderdate DESC, o_orderkey LIMIT 5"
    ),
    "type_filter": bm25(
        THE_AND,
        f"SELECT doc_id, round(sum(part), 4) AS score FROM c JOIN {TURNS} USING (doc_id) WHERE role = 'user' "
        "GROUP BY doc_id" + TOP + " LIMIT 50",
        source=TURNS,
    ),
    "dispatch": " UNION ALL ".join(
        f"SELECT * FROM (SELECT doc_id, score, '{kind}' AS kind FROM ({sql}){TOP} LIMIT 10)"
        for kind, sql in DISPATCHED.items()
    ),
    "search_many": many(
        ("text",), f"SELECT query_id, doc_id, round(s, 4) AS score FROM ({PASSAGE_PARTS})"
    ),
    "search_many_best": many(
        BOTH, f"SELECT query_id, doc_id, round(max(s), 4) AS score FROM ({PASSAGE_PARTS}) GROUP BY query_id, doc_id"
    ),
    "search_many_phrase": many(("text",), MANY_PHRASES),
    "search_many_query_string": many(BOTH, MANY_REQUESTS, WORD_SCORES),
    "search_many_wildcard": many(
        ("text",),
        "SELECT query_id, doc_id, CAST(1.0 AS DOUBLE) AS score FROM r JOIN (SELECT DISTINCT word, doc_id FROM "
        "(SELECT DISTINCT w1 AS word FROM r) JOIN dic ON contains(term, word) JOIN post USING (field, term)) ON word = w1",
    ),
    "search_many_term": many(
        ("text",), "SELECT query_id, doc_id, round(s, 4) AS score FROM r JOIN b ON term = w1", WORD_SCORES
    ),
    "terms_stats": (
        f"SELECT user_id AS key, count(*) AS doc_count, {stat('value', 'stats_lines_')} FROM events "
        "GROUP BY user_id ORDER BY doc_count DESC, key LIMIT 10"
    ),
    "terms_array": (
        f"SELECT key, count(*) AS doc_count, {stat('p_size', 'p_size_')} FROM "
        "(SELECT DISTINCT p_partkey, p_size, unnest(string_split(p_name, ' ')) AS key FROM part) "
        "GROUP BY key ORDER BY doc_count DESC, key LIMIT 10"
    ).replace("round(sum(p_size), 4)", "sum(p_size)::BIGINT"),
    "stats": f"SELECT {stat('value')} FROM events",
    "agg_with_query": (
        "SELECT source AS key, count(*) AS doc_count, count(n_chars) AS n_chars_count, min(n_chars) AS n_chars_min, "
        "max(n_chars) AS n_chars_max, round(avg(n_chars), 4) AS n_chars_avg, sum(n_chars)::BIGINT AS n_chars_sum "
        f"FROM documents WHERE doc_id IN (SELECT doc_id FROM ({tokens()}) WHERE token = 'the') "
        "GROUP BY source ORDER BY doc_count DESC, key LIMIT 10"
    ),
    "suggest": suggested(
        "SELECT 'my-suggest-1' AS name, 'text' AS field, unnest(['thiss', 'thatn', 'wihch', 'the']) AS token "
        "UNION ALL SELECT 'my-suggest-2', 'head', 'thiss'",
        BOTH,
    ),
    "suggest_many": suggested(
        f"SELECT doc_id AS name, 'text' AS field, token FROM ({tokens(source=TURNS)})", ("text",)
    ),
    "search_and_suggest": (
        f"SELECT 'hit' AS kind, doc_id::VARCHAR AS value, score FROM ({bm25(asked(('text',), 'the'), SUM)}{TOP} LIMIT 20) "
        "UNION ALL SELECT 'suggest', value, score FROM ("
        + suggested(
            "SELECT 'my-suggest-1' AS name, 'text' AS field, 'thiss' AS token",
            ("text",),
            "suggestion AS value, round(s, 4) AS score",
        )
        + ")"
    ),
}
ORACLE |= {f"{name}_pruned": ORACLE[name] for name in ("search_many", "search_many_best")}

_WORD_PIECE = r"regexp_matches(piece, '^[\p{L}\p{N}_]')"

ORACLE["search_many_typed"] = (
    f"WITH {corpus(('text',), TURNS)}, {PASSAGES}, h AS (SELECT query_id, doc_id, round(s, 4) AS score "
    f"FROM ({PASSAGE_PARTS}) JOIN {TURNS} AS t USING (doc_id) WHERE role = 'user'), "
    f"top AS ({RANKED}) SELECT query_id, rank, doc_id, score, 'user' AS role FROM top"
)

#: What explains and marks phrases and query strings.
ORACLE |= {
    "explain_phrase": (
        f"WITH {corpus()}, o AS (SELECT a.doc_id, count(*) AS tf FROM tok a JOIN tok b ON b.doc_id = a.doc_id "
        "AND b.position = a.position + 1 WHERE a.token = 'of' AND starts_with(b.token, 'th') GROUP BY a.doc_id), "
        "w AS (SELECT term, df FROM dic WHERE term = 'of' UNION ALL SELECT 'th*', count(DISTINCT doc_id) FROM tok "
        f"WHERE starts_with(token, 'th')) SELECT doc_id, term, tf, df, round({IDF} * {tf_norm()}, 4) AS contribution "
        "FROM o JOIN w ON TRUE JOIN len USING (doc_id) JOIN st USING (field)"
    ),
    "explain_query_string": bm25(
        best_words("the", "que", "en"),
        "SELECT doc_id, 'must 0' AS clause, field, slot AS term, round(s, 4) AS contribution FROM (SELECT *, "
        "row_number() OVER (PARTITION BY slot, doc_id ORDER BY s DESC, field) AS k FROM f) WHERE k = 1 "
        "AND slot IN ('the', 'que') AND doc_id NOT IN (SELECT doc_id FROM b WHERE slot = 'en')",
        more=WORDS,
    ),
    "highlight_phrase": (
        "WITH p AS (SELECT doc_id, generate_subscripts(t, 1) AS n, unnest(t) AS piece FROM (SELECT doc_id, "
        f"regexp_extract_all(text, {PIECES}) AS t FROM documents)), "
        "w AS (SELECT doc_id, n, coalesce(lower(piece) = 'of' AND starts_with(lead(lower(piece)) OVER o, 'th'), FALSE) AS b "
        f"FROM p WHERE {_WORD_PIECE} WINDOW o AS (PARTITION BY doc_id ORDER BY n)), "
        "m AS (SELECT doc_id, n, b OR coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY n), FALSE) AS m FROM w) "
        "SELECT doc_id, string_agg(CASE WHEN coalesce(m, FALSE) THEN '<em>' || piece || '</em>' ELSE piece END, '' ORDER BY n) "
        "AS highlight FROM p LEFT JOIN m USING (doc_id, n) GROUP BY doc_id HAVING bool_or(coalesce(m, FALSE))"
    ),
    "highlight_query_string": (
        ORACLE["highlight"].replace("'and'", "'que'")
        + f" AND doc_id NOT IN (SELECT doc_id FROM ({tokens()}) WHERE token = 'en')"
    ),
}
