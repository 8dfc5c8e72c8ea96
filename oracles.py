"""For each registered query, SQL that computes the same rows from the given tables."""

from __future__ import annotations

from registry import CODES, HAN_LETTERS, LETTERS, STOP_WORDS, TOKEN_LIMIT, TOP

WORD = r"[\p{L}\p{N}]+"
ASCII = "[a-z0-9]+"
_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
_CODES = "|".join(c.lower().replace(".", r"\.") for c in sorted(CODES, key=lambda c: (-len(c), c)))


def words(relation: str, keys: str, text: str = "text", pattern: str = WORD, fold: bool = True) -> str:
    """Rows (keys, pos, term) of a relation."""
    folded = f"lower({text})" if fold else text
    return f"""SELECT {keys}, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS term
        FROM (SELECT {keys}, regexp_extract_all({folded}, '{pattern}') AS w FROM {relation})"""


def long_form(table: str, key: str, fields: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT {key} AS doc_id, '{f}' AS field, {f} AS text FROM {table}" for f in fields)


def index_ctes(long: str, docs: str, pattern: str = WORD, tokens: str | None = None) -> str:
    tokens = tokens or words("texts", "doc_id, field", pattern=pattern)
    return f"""texts AS ({long}),
    tok AS MATERIALIZED ({tokens}),
    post AS MATERIALIZED (SELECT field, term, doc_id, CAST(count(*) AS BIGINT) AS tf FROM tok GROUP BY ALL),
    lens AS MATERIALIZED (SELECT field, doc_id, CAST(sum(tf) AS BIGINT) AS n FROM post GROUP BY ALL),
    stats AS MATERIALIZED (SELECT field, term, count(*) AS df FROM post GROUP BY ALL),
    corpus AS (SELECT count(*) AS docs FROM {docs})"""


IDF = "1 + ln((SELECT docs FROM corpus) / (coalesce(df, 0) + 1.0))"


def ranked(scored: str, k: int = TOP) -> str:
    return f"""SELECT query_id, doc_id, score, rank, total_hits FROM (
        SELECT query_id, doc_id, score,
            CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS BIGINT) AS rank,
            CAST(count(*) OVER (PARTITION BY query_id) AS BIGINT) AS total_hits FROM {scored}) WHERE rank <= {k}"""


def blank_words(relation: str, keys: str) -> str:
    """Rows (keys, pos, word) of the blank-separated words."""
    return f"""SELECT {keys}, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word
        FROM (SELECT {keys}, regexp_extract_all(text, '\\S+') AS w FROM {relation})"""


def words_of_blanks(relation: str, keys: str, pattern: str = WORD) -> str:
    """Rows (keys, pos, term): the terms of each blank-separated word, all with that word's place."""
    return f"""SELECT {keys}, pos, unnest(regexp_extract_all(lower(word), '{pattern}')) AS term
        FROM ({blank_words(relation, keys)})"""


def keyword_ctes(queries: str, fields: list[str], and_: bool = False, query_tokens: str | None = None) -> str:
    """Clause ``terms`` over fields: tables qunit(query_id, unit, m), qterm(…, field, term, idf) and kw(query_id, doc_id, score parts).

    Over several fields a unit is a blank-separated word; with AND some field must hold all terms it makes of the word.
    """
    names = ", ".join(f"'{f}'" for f in fields)
    split = words("queries", "query_id") if len(fields) == 1 else words_of_blanks("queries", "query_id")
    tokens = query_tokens or f"SELECT query_id, pos, field, term FROM ({split}) CROSS JOIN (SELECT unnest([{names}]) AS field)"
    needed = "units.total" if and_ else "0"
    return f"""queries AS ({queries}),
    qtok AS MATERIALIZED (SELECT DISTINCT query_id, pos, field, term FROM ({tokens})),
    qword AS (SELECT query_id, pos, list(field || ' ' || term ORDER BY field, term) AS word FROM qtok GROUP BY ALL),
    qunit AS MATERIALIZED (SELECT query_id, word, min(pos) AS unit, count(*) AS m FROM qword GROUP BY ALL),
    units AS MATERIALIZED (SELECT query_id, sum(m) AS total FROM qunit GROUP BY ALL),
    qterm AS MATERIALIZED (SELECT u.query_id, u.unit, u.m, t.field, t.term, {IDF} AS idf,
            count(*) OVER (PARTITION BY u.query_id, u.unit, t.field) AS parts
        FROM qunit u JOIN qtok t ON t.query_id = u.query_id AND t.pos = u.unit
        LEFT JOIN stats s ON s.field = t.field AND s.term = t.term),
    qsum AS MATERIALIZED (SELECT query_id, sum(m * idf * idf) AS squares FROM qterm GROUP BY ALL),
    byfield AS MATERIALIZED (SELECT q.query_id, q.unit, q.m, p.doc_id, q.field, count(*) = any_value(q.parts) AS whole,
            sum(q.m * q.idf * q.idf * sqrt(p.tf) / sqrt(l.n)) AS part
        FROM qterm q JOIN post p ON p.field = q.field AND p.term = q.term
        JOIN lens l ON l.field = p.field AND l.doc_id = p.doc_id GROUP BY ALL),
    byunit AS MATERIALIZED (SELECT query_id, unit, m, doc_id, sum(part) AS part, bool_or(whole) AS whole FROM byfield
        GROUP BY query_id, unit, m, doc_id),
    kw AS MATERIALIZED (SELECT b.query_id, b.doc_id, sum(part) * sum(b.m) / any_value(units.total) AS part
        FROM byunit b JOIN units ON units.query_id = b.query_id
        GROUP BY b.query_id, b.doc_id, units.total HAVING coalesce(sum(b.m) FILTER (WHERE whole), 0) >= {needed})"""


KEYWORD_SCORED = """(SELECT kw.query_id, doc_id, round(part / sqrt(squares), 6) AS score
    FROM kw JOIN qsum ON qsum.query_id = kw.query_id)"""

DOC_FIELDS = ["text", "source", "lang"]
TEXT_INDEX = index_ctes(long_form("documents", "doc_id", ["text"]), "documents")
DOCS_INDEX = index_ctes(long_form("documents", "doc_id", DOC_FIELDS), "documents")
BENCHMARK = "SELECT item_id AS query_id, text FROM benchmark"
BENCHMARK_WORDS = f"""SELECT query_id * 10000 + pos AS query_id, term AS text
    FROM ({words('(' + BENCHMARK + ')', 'query_id', fold=False)})"""


def windows(size: int) -> str:
    parts = [f"lead(term, {i}) OVER (PARTITION BY query_id ORDER BY pos)" for i in range(1, size)]
    joined = " || ' ' || ".join(["term", *parts])
    return f"""SELECT query_id, text FROM (SELECT query_id * 10000 + pos AS query_id, {joined} AS text
        FROM ({words('(' + BENCHMARK + ')', 'query_id')})) WHERE text IS NOT NULL"""


def expansion_scored(pairs: str) -> str:
    """Constant score of documents holding any term paired with the query."""
    return f"(SELECT DISTINCT x.query_id, p.doc_id, CAST(1.0 AS DOUBLE) AS score FROM ({pairs}) x JOIN post p ON p.term = x.term)"


def wildcard_like(column: str) -> str:
    # The patterns here hold letters, digits, * and ? only.
    return f"replace(replace({column}, '*', '%'), '?', '_')"


def fuzzy_pairs(queries: str) -> str:
    """(query, term, boost) of similar terms."""
    near = "1 - levenshtein(s.term, q.text) / least(length(s.term), length(q.text))"
    return f"""SELECT q.query_id, s.term, s.df, CASE WHEN length(q.text) <= 2 THEN 1.0 ELSE ({near} - 0.5) / 0.5 END AS boost
        FROM {queries} q JOIN stats s ON s.field = 'text'
        AND CASE WHEN length(q.text) <= 2 THEN s.term = q.text
            ELSE length(s.term) * 2 > length(q.text) AND length(s.term) < 2 * length(q.text) AND {near} > 0.5 END"""


def phrase_ctes(size: int, slop: int) -> str:
    """Phrases of ``size`` words; every combination of positions is tried."""
    first = "p0.pos"
    joins, adjusted = [], [first]
    for i in range(1, size):
        joins.append(
            f"JOIN tok p{i} ON p{i}.doc_id = p0.doc_id AND p{i}.term = q.t{i} AND p{i}.pos - {i} BETWEEN p0.pos - {slop} AND p0.pos + {slop}"
            + "".join(f" AND p{i}.pos <> p{j}.pos" for j in range(i))
        )
        adjusted.append(f"p{i}.pos - {i}")
    spread = f"greatest({', '.join(adjusted)}) - least({', '.join(adjusted)})"
    names = ", ".join(f"string_split(text, ' ')[{i + 1}] AS t{i}" for i in range(size))
    idfs = " + ".join(f"(SELECT {IDF} FROM (SELECT max(df) AS df FROM stats WHERE term = t{i}))" for i in range(size))
    return f"""queries AS ({windows(size)}),
    phrase AS MATERIALIZED (SELECT query_id, {names} FROM queries),
    weight AS MATERIALIZED (SELECT query_id, {idfs} AS idf FROM phrase),
    spreads AS MATERIALIZED (SELECT q.query_id, p0.doc_id, p0.pos, min({spread}) AS spread
        FROM phrase q JOIN tok p0 ON p0.term = q.t0 {' '.join(joins)} GROUP BY ALL HAVING min({spread}) <= {slop}),
    freqs AS MATERIALIZED (SELECT query_id, doc_id, sum(1.0 / (1 + spread)) AS freq FROM spreads GROUP BY ALL)"""


PHRASE_SCORED = """(SELECT f.query_id, f.doc_id, round(sqrt(freq) * idf / sqrt(n), 6) AS score
    FROM freqs f JOIN weight w ON w.query_id = f.query_id JOIN lens l ON l.doc_id = f.doc_id)"""

_ASCII_FIELDS_INDEX = index_ctes(long_form("documents", "doc_id", DOC_FIELDS), "documents", pattern=ASCII)

_UPDATES = """SELECT doc_id, 'reviewed ' || CASE WHEN toxic = 1 THEN 'withheld' ELSE text END AS text
    FROM documents JOIN labels USING (doc_id)"""
_AFTER_UPSERT = f"""changed AS ({_UPDATES}),
    current AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM changed)
        UNION ALL SELECT doc_id, text FROM changed)"""
_CURRENT_INDEX = index_ctes("SELECT doc_id, 'text' AS field, text FROM current", "current")
_STATS = "SELECT field, term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS total_tf"

_TOP3 = f"WITH {TEXT_INDEX}, {keyword_ctes(BENCHMARK, ['text'])} {ranked(KEYWORD_SCORED)}"

_SOURCE_TOKENS = f"""SELECT doc_id, field, pos, term FROM ({words("(SELECT * FROM texts WHERE field <> 'source')", 'doc_id, field')})
        WHERE NOT (field = 'text' AND list_contains({_STOP}, term))
    UNION ALL SELECT doc_id, field, 0, text FROM texts WHERE field = 'source'"""
_PER_FIELD_QUERY_TOKENS = f"""SELECT query_id, pos, field, term FROM ({words_of_blanks('queries', 'query_id')})
        CROSS JOIN (SELECT unnest(['text', 'lang']) AS field) WHERE NOT (field = 'text' AND list_contains({_STOP}, term))
    UNION ALL SELECT query_id, pos, 'source', word FROM ({blank_words('queries', 'query_id')})"""
_PER_FIELD_QUERIES = f"""SELECT item_id AS query_id, text || ' fr src' || CAST(item_id % 20 AS VARCHAR) AS text FROM benchmark UNION ALL
    SELECT item_id + 100000, 'src' || CAST(item_id % 20 AS VARCHAR) FROM benchmark"""
_PER_FIELD_AND = f"""SELECT query_id, text || ' src' || CAST(query_id % 20 AS VARCHAR) AS text FROM ({windows(2)})"""
_PER_FIELD_INDEX = index_ctes(long_form("documents", "doc_id", DOC_FIELDS), "documents", tokens=_SOURCE_TOKENS)

_ORDERS = "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders"
_PARTS_TEXT = """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
    CAST(p_retailprice AS VARCHAR) AS p_retailprice, (SELECT count(*) + 1 FROM part) AS written FROM part"""

_BOOL_FIRST = "SELECT item_id AS query_id, regexp_extract_all(lower(text), '[a-z0-9]+')[1] AS text, regexp_extract_all(lower(text), '[a-z0-9]+')[2] AS next, regexp_extract_all(lower(text), '[a-z0-9]+')[3] AS last FROM benchmark"
_NAMES = ", ".join(f"'{f}'" for f in DOC_FIELDS)
_BOOL_TOKENS = f"""SELECT query_id, pos, field, term FROM ({words_of_blanks('queries', 'query_id', pattern=ASCII)})
        CROSS JOIN (SELECT unnest([{_NAMES}]) AS field)"""



def _bool_phrase(name: str, one: str, two: str) -> str:
    """A phrase of two words of first_word in any field, without slop: tables {name}_sum(query_id, squares), {name}_hits."""
    idf = "(SELECT {} FROM (SELECT max(df) AS df FROM stats WHERE stats.field = f.field AND term = w.{}))"
    return f"""{name}_field AS MATERIALIZED (SELECT query_id, f.field, w.{one} AS one, w.{two} AS two, {idf.format(IDF, one)} + {idf.format(IDF, two)} AS idf
            FROM first_word w CROSS JOIN (SELECT unnest([{_NAMES}]) AS field) f),
        {name}_sum AS MATERIALIZED (SELECT query_id, sum(idf * idf) AS squares FROM {name}_field GROUP BY ALL),
        {name}_freq AS (SELECT query_id, p.field, a.doc_id, any_value(idf) AS idf, count(*) AS freq FROM {name}_field p
            JOIN tok a ON a.field = p.field AND a.term = one JOIN tok b ON b.field = p.field AND b.doc_id = a.doc_id AND b.term = two AND b.pos = a.pos + 1
            GROUP BY query_id, p.field, a.doc_id),
        {name}_hits AS MATERIALIZED (SELECT query_id, f.doc_id, sum(idf * idf * sqrt(freq) / sqrt(n)) AS part FROM {name}_freq f
            JOIN lens l ON l.field = f.field AND l.doc_id = f.doc_id GROUP BY query_id, f.doc_id)"""


SQL = {
    "tokens": words("documents", "doc_id"),
    "tokens_nostop": f"SELECT * FROM ({words('documents', 'doc_id')}) WHERE NOT list_contains({_STOP}, term)",
    "tokens_nostop_table": f"""SELECT * FROM ({words('documents', 'doc_id')})
        WHERE term NOT IN (SELECT term FROM ({words('benchmark', 'item_id')}))""",
    "tokens_keep_codes": words("documents", "doc_id", pattern=f"{_CODES}|{WORD}"),
    "tokens_keep_codes_table": words(
        "(SELECT p_partkey, p_brand || ' / ' || p_name || ' / ' || p_type AS text FROM part)", "p_partkey",
        pattern=f"brand#[0-9]+|{WORD}"),
    "normalize_queries": f"""SELECT item_id AS query_id,
        coalesce(array_to_string(list_transform(regexp_extract_all(lower(text), '{WORD}'), lambda t: t || ' '), ''), '') AS normalized
        FROM benchmark""",
    "analyze_per_field": f"WITH texts AS ({long_form('documents', 'doc_id', DOC_FIELDS)}) {_SOURCE_TOKENS}",
    "token_limit": f"""WITH t AS ({words('documents', 'doc_id')}),
        k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM t WHERE NOT list_contains({_STOP}, term)),
        a AS (SELECT doc_id, count(*) AS places FROM t GROUP BY ALL),
        b AS (SELECT doc_id, count(*) AS all_tokens, count(*) FILTER (WHERE place <= {TOKEN_LIMIT}) AS kept_tokens,
            max(pos) FILTER (WHERE place = {TOKEN_LIMIT}) AS cut FROM k GROUP BY ALL)
        SELECT d.doc_id, CAST(coalesce(all_tokens, 0) AS BIGINT) AS all_tokens, CAST(coalesce(kept_tokens, 0) AS BIGINT) AS kept_tokens,
            CAST(coalesce(cut + 1, places, 0) AS BIGINT) AS kept_places
        FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)""",
    "postings": f"""WITH {DOCS_INDEX} SELECT field, term, doc_id, CAST(count(*) AS BIGINT) AS tf,
        string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions FROM tok GROUP BY ALL""",
    "term_stats": f"WITH {DOCS_INDEX} {_STATS} FROM post GROUP BY ALL",
    "field_norms": f"WITH {DOCS_INDEX} SELECT field, doc_id, n AS length, round(1 / sqrt(n), 9) AS norm FROM lens",
    "corpus_size": "SELECT CAST(count(*) AS BIGINT) AS docs FROM documents",
    "index_append": f"""WITH {index_ctes(long_form('documents', 'doc_id', ['text', 'lang']), 'documents')}
        {_STATS}, (SELECT docs FROM corpus) AS docs FROM post GROUP BY field, term""",
    "index_snapshot": " UNION ALL ".join(
        f"""SELECT '{v}' AS version, (SELECT count(*) FROM documents WHERE {c}) AS docs, count(DISTINCT term) AS terms,
            CAST(sum(n) AS BIGINT) AS postings, CAST(sum(t) AS BIGINT) AS tokens FROM (
            SELECT term, count(DISTINCT doc_id) AS n, count(*) AS t
            FROM ({words(f'(SELECT * FROM documents WHERE {c})', 'doc_id')}) GROUP BY term)"""
        for v, c in (("first", "lang <> 'en'"), ("last", "true"), ("compacted", "true"))),
    "index_upsert": f"""WITH {_AFTER_UPSERT}, {_CURRENT_INDEX}
        {_STATS}, (SELECT docs FROM corpus) AS docs FROM post GROUP BY field, term""",
    "search_after_upsert": f"""WITH {_AFTER_UPSERT}, {_CURRENT_INDEX},
        {keyword_ctes("SELECT item_id AS query_id, text || ' reviewed withheld superseded' AS text FROM benchmark", ['text'])}
        {ranked(KEYWORD_SCORED)}""",
    "search_or_top3": _TOP3,
    "search_total_hits": f"""WITH {TEXT_INDEX}, {keyword_ctes(BENCHMARK, ['text'])}
        SELECT q.query_id, CAST(count(kw.doc_id) AS BIGINT) AS total_hits FROM queries q LEFT JOIN kw ON kw.query_id = q.query_id
        GROUP BY q.query_id UNION ALL SELECT -item_id - 1, 0 FROM benchmark""",
    "search_and": f"WITH {TEXT_INDEX}, {keyword_ctes(windows(3), ['text'], and_=True)} {ranked(KEYWORD_SCORED)}",
    "search_multifield": f"""WITH {DOCS_INDEX},
        {keyword_ctes("SELECT item_id AS query_id, text || ' en fr src' || CAST(item_id % 20 AS VARCHAR) AS text FROM benchmark", DOC_FIELDS)}
        {ranked(KEYWORD_SCORED)}""",
    "search_multifield_and": f"""WITH {DOCS_INDEX},
        {keyword_ctes(f"SELECT query_id, text || ' en' AS text FROM ({windows(2)})", DOC_FIELDS, and_=True)} {ranked(KEYWORD_SCORED)}""",
    "search_parts": f"""WITH {index_ctes(long_form('part', 'p_partkey', ['p_name', 'p_brand', 'p_type']), 'part')},
        {keyword_ctes("SELECT min(p_partkey) AS query_id, p_name || ' ' || p_type AS text FROM part GROUP BY p_name, p_type", ['p_name', 'p_brand', 'p_type'])}
        {ranked(KEYWORD_SCORED)}""",
    "search_per_field": f"""WITH {_PER_FIELD_INDEX},
        {keyword_ctes(_PER_FIELD_QUERIES, DOC_FIELDS, query_tokens=_PER_FIELD_QUERY_TOKENS)} {ranked(KEYWORD_SCORED)}""",
    "search_per_field_and": f"""WITH {_PER_FIELD_INDEX},
        {keyword_ctes(_PER_FIELD_AND, DOC_FIELDS, True, _PER_FIELD_QUERY_TOKENS)} {ranked(KEYWORD_SCORED)}""",
    "search_term": f"""WITH {TEXT_INDEX}, queries AS ({BENCHMARK_WORDS}) {ranked(f'''(SELECT query_id, p.doc_id,
        round(({IDF}) * sqrt(tf) / sqrt(n), 6) AS score FROM queries q JOIN stats s ON s.term = q.text
        JOIN post p ON p.term = q.text JOIN lens l ON l.doc_id = p.doc_id)''')}""",
    "search_prefix": f"""WITH {TEXT_INDEX}, queries AS (SELECT query_id, lower(left(text, 4)) AS text FROM ({BENCHMARK_WORDS}))
        {ranked(expansion_scored('SELECT query_id, term FROM queries JOIN stats ON starts_with(term, text)'))}""",
    "search_wildcard": f"""WITH {TEXT_INDEX}, queries AS (SELECT query_id, {wildcard_like('lower(p)')} AS text FROM (
            SELECT query_id, CASE query_id % 4 WHEN 0 THEN left(text, 2) || '*' || right(text, 2) WHEN 1 THEN '*' || right(text, 4)
                WHEN 2 THEN '?' || substr(text, 2, 20) || '*' ELSE '*' || substr(text, 2, 3) || '?' END AS p FROM ({BENCHMARK_WORDS}))),
        patterns AS MATERIALIZED (SELECT DISTINCT text FROM queries),
        found AS MATERIALIZED (SELECT text, term FROM patterns JOIN stats ON term LIKE text)
        {ranked(expansion_scored('SELECT query_id, term FROM queries JOIN found ON found.text = queries.text'))}""",
    "search_fuzzy": f"""WITH {index_ctes(long_form('documents', 'doc_id', ['text']), 'documents', pattern=ASCII)},
        queries AS MATERIALIZED (SELECT query_id * 10000 + pos AS query_id, term AS text
            FROM ({words('(' + BENCHMARK + ')', 'query_id', pattern=ASCII)})),
        distinct_words AS MATERIALIZED (SELECT DISTINCT text AS query_id, text FROM queries),
        near AS MATERIALIZED ({fuzzy_pairs('distinct_words')}),
        weighted AS MATERIALIZED (SELECT query_id AS word, term, {IDF} AS idf, boost FROM near),
        sums AS MATERIALIZED (SELECT word, sum(idf * boost * idf * boost) AS squares FROM weighted GROUP BY ALL),
        parts AS MATERIALIZED (SELECT w.word, p.doc_id, sum(idf * idf * boost * sqrt(tf) / sqrt(n)) AS part FROM weighted w
            JOIN post p ON p.term = w.term JOIN lens l ON l.doc_id = p.doc_id GROUP BY ALL)
        {ranked('''(SELECT q.query_id, p.doc_id, round(part / sqrt(squares), 6) AS score FROM queries q
            JOIN parts p ON p.word = q.text JOIN sums s ON s.word = q.text)''')}""",
    "search_phrase": f"WITH {TEXT_INDEX}, {phrase_ctes(2, 0)} {ranked(PHRASE_SCORED)}",
    "search_phrase_slop": f"WITH {TEXT_INDEX}, {phrase_ctes(3, 2)} {ranked(PHRASE_SCORED)}",
    "search_boolean": f"""WITH {_ASCII_FIELDS_INDEX}, {keyword_ctes(BENCHMARK, DOC_FIELDS, query_tokens=_BOOL_TOKENS)},
        first_word AS MATERIALIZED ({_BOOL_FIRST}),
        tw AS MATERIALIZED (SELECT query_id, f.text, {IDF} AS idf FROM first_word f LEFT JOIN stats s ON s.field = 'text' AND s.term = f.text),
        near AS MATERIALIZED ({fuzzy_pairs('first_word')}),
        fz AS MATERIALIZED (SELECT query_id, term, {IDF} AS idf, boost FROM near),
        fsum AS (SELECT query_id, sum(idf * boost * idf * boost) AS squares FROM fz GROUP BY ALL),
        {_bool_phrase('pair', 'next', 'last')},
        norm AS MATERIALIZED (SELECT f.query_id, 1 / sqrt(coalesce(q.squares, 0) + t.idf * t.idf + 1 + 1 + coalesce(z.squares, 0) + coalesce(y.squares, 0)) AS qn
            FROM first_word f LEFT JOIN qsum q ON q.query_id = f.query_id JOIN tw t ON t.query_id = f.query_id
            LEFT JOIN fsum z ON z.query_id = f.query_id LEFT JOIN pair_sum y ON y.query_id = f.query_id),
        parts AS (
            SELECT 1 AS clause, query_id, doc_id, part FROM kw
            UNION ALL SELECT 2, query_id, p.doc_id, idf * idf * sqrt(tf) / sqrt(n) FROM tw
                JOIN post p ON p.field = 'text' AND p.term = tw.text JOIN lens l ON l.field = 'text' AND l.doc_id = p.doc_id
            UNION ALL SELECT DISTINCT 3, query_id, doc_id, 1.0 FROM first_word JOIN post ON field = 'text' AND starts_with(term, text)
            UNION ALL SELECT DISTINCT 4, query_id, doc_id, 1.0 FROM first_word JOIN post ON field = 'text' AND starts_with(term, left(text, 3))
            UNION ALL SELECT 5, query_id, p.doc_id, sum(idf * idf * boost * sqrt(tf) / sqrt(n)) FROM fz
                JOIN post p ON p.field = 'text' AND p.term = fz.term JOIN lens l ON l.field = 'text' AND l.doc_id = p.doc_id
                GROUP BY query_id, p.doc_id
            UNION ALL SELECT 8, query_id, doc_id, part FROM pair_hits),
        banned AS (SELECT query_id, doc_id FROM first_word CROSS JOIN documents WHERE lang = 'fr'
            UNION SELECT query_id, a.doc_id FROM first_word JOIN tok a ON a.field = 'text' AND a.term = text
                JOIN tok b ON b.field = 'text' AND b.doc_id = a.doc_id AND b.term = next AND abs(b.pos - 1 - a.pos) <= 1),
        scored AS (SELECT p.query_id, p.doc_id, round(any_value(qn) * sum(part) * count(*) / 6, 6) AS score
            FROM parts p JOIN norm ON norm.query_id = p.query_id ANTI JOIN banned b ON b.query_id = p.query_id AND b.doc_id = p.doc_id
            GROUP BY p.query_id, p.doc_id HAVING count(*) FILTER (WHERE clause = 4) = 1)
        {ranked('scored')}""",
    "search_boolean_phrase": f"""WITH {_ASCII_FIELDS_INDEX}, first_word AS MATERIALIZED ({_BOOL_FIRST}),
        {_bool_phrase('pair', 'text', 'next')}, {_bool_phrase('other', 'next', 'last')},
        scored AS (SELECT p.query_id, p.doc_id,
                round((p.part + coalesce(o.part, 0)) / sqrt(a.squares + b.squares) * (CASE WHEN o.part IS NULL THEN 1 ELSE 2 END) / 2, 6) AS score
            FROM pair_hits p JOIN pair_sum a ON a.query_id = p.query_id JOIN other_sum b ON b.query_id = p.query_id
            LEFT JOIN other_hits o ON o.query_id = p.query_id AND o.doc_id = p.doc_id)
        {ranked('scored')}""",
    "hits_hydrated": f"""SELECT query_id, rank, score, t.doc_id, lang || source || text AS shown
        FROM ({_TOP3}) t JOIN documents d ON d.doc_id = t.doc_id""",
    "bind_model": """SELECT o_orderkey AS "O_OrderKey", o_orderstatus AS "O_OrderStatus", o_orderpriority AS "O_OrderPriority",
        o_totalprice AS "O_TotalPrice", CAST(NULL AS VARCHAR) AS "O_Clerk", CAST(0 AS INTEGER) AS "O_Lines" FROM orders""",
    "bind_rejects": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus
        ELSE CAST(o_orderkey % 7 AS VARCHAR) END AS o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN 'o_orderstatus' ELSE '' END AS bad_fields FROM orders""",
    "role_projection": """SELECT CAST(o_orderkey AS VARCHAR) AS "O_OrderKey", o_orderstatus AS "O_OrderStatus",
        o_orderpriority AS "O_OrderPriority" FROM orders""",
    "field_rows": """SELECT o_orderkey AS "O_OrderKey", 'O_OrderStatus' AS field, o_orderstatus AS text FROM orders
        UNION ALL SELECT o_orderkey, 'O_OrderPriority', o_orderpriority FROM orders""",
    "skip_empty": """SELECT * FROM (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_name END AS p_name,
        CASE WHEN p_type <> 'SMALL' THEN p_brand END AS p_brand FROM part) WHERE p_name IS NOT NULL OR p_brand IS NOT NULL""",
    "positional_union": """SELECT n_nationkey, n_name FROM nation
        UNION ALL SELECT CAST(s_suppkey AS INTEGER), s_name FROM supplier""",
    "export_text": _PARTS_TEXT,
    "workbook_tables": _PARTS_TEXT,
    "workbook_no_header": """SELECT CAST(p_partkey AS VARCHAR) AS _c0, p_name AS _c1, p_brand AS _c2 FROM part""",
    "stream_search": f"""SELECT * FROM ({_TOP3}) UNION ALL SELECT -item_id - 1, NULL, NULL, NULL, 0 FROM benchmark""",
    **dict.fromkeys(("stream_upsert", "upsert_out_of_order"), f"""WITH {_AFTER_UPSERT}, {_CURRENT_INDEX}
        {_STATS}, (SELECT docs FROM corpus) AS docs FROM post GROUP BY field, term"""),
}

# Han runs: every word of the mapped text split where the script changes.
def han_runs(keys: str, table: str) -> str:
    mapped = f"translate(lower(text), '{LETTERS}', '{HAN_LETTERS}')"
    return f"""runs AS MATERIALIZED (SELECT {keys}, CAST(generate_subscripts(r, 1) AS INTEGER) AS run, unnest(r) AS chars FROM (
        SELECT {keys}, regexp_extract_all(regexp_replace({mapped}, '(\\p{{Han}}+)', ' \\1 ', 'g'), '{WORD}') AS r FROM {table}))"""


_HAN_RUN = "regexp_matches(chars, '^\\p{Han}')"

SQL["bigrams_han"] = f"""WITH {han_runs('doc_id', 'documents')},
    pieces AS (SELECT doc_id, run, CASE WHEN {_HAN_RUN} AND length(chars) > 1
        THEN list_transform(range(1, length(chars)), lambda i: substr(chars, i, 2)) ELSE [chars] END AS w FROM runs),
    flat AS (SELECT doc_id, run, generate_subscripts(w, 1) AS i, unnest(w) AS term FROM pieces)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY run, i) - 1 AS INTEGER) AS pos, term FROM flat"""

def segmented_ctes(keys: str, table: str) -> str:
    """Table alltok(keys, pos, term): the Han-written texts of a table cut by the benchmark words."""
    return f"""{han_runs(keys, table)},
    dict AS MATERIALIZED (SELECT DISTINCT translate(term, '{LETTERS}', '{HAN_LETTERS}') AS word
        FROM ({words('benchmark', 'item_id', pattern=ASCII)}) WHERE regexp_full_match(term, '[a-z]+')),
    longest AS (SELECT max(length(word)) AS n FROM dict),
    distinct_runs AS MATERIALIZED (SELECT DISTINCT chars FROM runs),
    places AS (SELECT chars, unnest(range(1, length(chars) + 1)) AS place FROM distinct_runs WHERE {_HAN_RUN}),
    grams AS (SELECT chars, place, unnest(range(2, least((SELECT n FROM longest), length(chars) - place + 1) + 1)) AS n FROM places),
    hits AS MATERIALIZED (SELECT chars, place, max(n) AS n FROM grams JOIN dict ON word = substr(chars, place, n) GROUP BY ALL),
    steps AS (SELECT chars, CAST(1 AS BIGINT) AS place, CAST(0 AS BIGINT) AS i FROM distinct_runs WHERE {_HAN_RUN}
        UNION ALL SELECT s.chars, s.place + coalesce(h.n, 1), s.i + 1
        FROM steps s LEFT JOIN hits h ON h.chars = s.chars AND h.place = s.place WHERE s.place + coalesce(h.n, 1) <= length(s.chars)),
    pieces AS (SELECT s.chars, s.i, substr(s.chars, s.place, coalesce(h.n, 1)) AS term
        FROM steps s LEFT JOIN hits h ON h.chars = s.chars AND h.place = s.place
        UNION ALL SELECT chars, 0, chars FROM distinct_runs WHERE NOT {_HAN_RUN}),
    alltok AS MATERIALIZED (SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY run, i) - 1 AS INTEGER) AS pos, term
        FROM runs JOIN pieces USING (chars))"""


SQL["segment_han"] = f"WITH RECURSIVE {segmented_ctes('conv_id, turn', 'conversations')} SELECT conv_id, turn, pos, term FROM alltok"

_BOTH = """(SELECT 'd' AS side, conv_id * 1000 + turn AS id, text FROM conversations
        UNION ALL SELECT 'q', item_id, text FROM benchmark)"""
_SEGMENTED_INDEX = index_ctes(
    "SELECT 1 AS unused", "conversations", tokens="SELECT id AS doc_id, 'text' AS field, pos, term FROM alltok WHERE side = 'd'"
)
_SEGMENTED_QUERY = "SELECT id AS query_id, pos, 'text' AS field, term FROM alltok WHERE side = 'q'"
SQL["search_segmented"] = f"""WITH RECURSIVE {segmented_ctes('side, id', _BOTH)}, {_SEGMENTED_INDEX},
    {keyword_ctes(BENCHMARK, ['text'], query_tokens=_SEGMENTED_QUERY)} {ranked(KEYWORD_SCORED)}"""
