"""DuckDB oracle SQL for registered queries (tables are pre-registered views).

Written independently of the Spark code: RE2 has no look-around and an ASCII
``\\b``, so word boundaries are emulated by padding with spaces and explicit
Unicode classes.  Queries without an entry get the driver's rows-only check.
"""

from __future__ import annotations

import re
import warnings

from hirelens import config
from hirelens.plans import oracle_orders as orders

# The query profile and dictionary of the documents adapter, restated.
DOC_MUST, DOC_NICE = ["de", "der", "rewh"], ["la", "und", "tion", "orre"]
DOC_KEYWORDS, DOC_EXCLUDED = ["de la", "der", "thatin", "ononst", "que"], ["und", "el"]
DOC_MIN_SALARY = 5000
DOC_DICTIONARY = ["that", "with", "this", "from", "de", "und", "la", "c++", "go", "ai", "java", "ed", "tion"]
ORDER_DICTIONARY = orders.DICTIONARY
# The validation rules' values, restated; only the 318 stop words are read from the configuration (a fixed published list).
SPAM = ["test job", "sample job", "fake job", "placeholder", "[job description]"]
SOURCES = ["linkedin", "upwork", "indeed"]
SHORTEST_TITLE = 10
PAGE_LINKS = {"tag": "a", "attr": "href", "sep": "/", "part": 1}

# The three salary ranges of the rules, tried in this order.
_PERIOD = "(?P<period>per year|per month|per hour|yearly|monthly|hourly)?"
SALARY_RANGES = [
    r"(?P<currency>\$|€|£)?\s*(?P<min>[\d,]+)\s*[-–to]+\s*(?P<currency2>\$|€|£)?\s*(?P<max>[\d,]+)\s*" + _PERIOD,
    r"(?P<currency>\$|€|£)?\s*(?P<min>[\d,]+k)\s*[-–to]+\s*(?P<currency2>\$|€|£)?\s*(?P<max>[\d,]+k)\s*" + _PERIOD,
    r"(?P<min>[\d,]+)\s*[-–to]+\s*(?P<max>[\d,]+)\s*(?P<currency>USD|EUR|GBP)",
]

WS = r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


DOC_POSTINGS = """postings AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id AS input_seq, split_part(text, chr(10), 1) AS title,
         text AS description, src AS source,
         'https://www.' || src || '.com/jobs/' || substr(md5(text), 1, 12) AS url
  FROM (SELECT *, CASE lang WHEN 'en' THEN 'linkedin' WHEN 'fr' THEN 'upwork' WHEN 'de' THEN 'indeed'
                  ELSE lang END AS src FROM documents))"""


def reject_reason_sql() -> str:
    spam = " OR ".join(f"contains(lower(coalesce(title, '')), {q(p)}) OR contains(lower(coalesce(description, '')), {q(p)})"
                       for p in SPAM)
    srcs = ", ".join(q(s) for s in SOURCES)
    return (f"CASE WHEN title IS NULL OR length({strip('title')}) < {SHORTEST_TITLE} THEN 'short_title' "
            f"WHEN source IS NOT NULL AND lower(source) NOT IN ({srcs}) THEN 'bad_source' "
            f"WHEN {spam} THEN 'spam' END")


def _word_pattern(term: str) -> str:
    first = WORD if not re.match(r"\w", term[:1]) else NON_WORD
    last = WORD if not re.match(r"\w", term[-1:]) else NON_WORD
    return first + re.escape(term) + last


def doc_skills_sql(text_expr: str, terms: list[str]) -> str:
    padded = f"(' ' || lower(coalesce({text_expr}, '')) || ' ')"
    hits = ", ".join(f"CASE WHEN regexp_matches({padded}, {q(_word_pattern(t))}) THEN {q(t)} END" for t in terms)
    return f"array_to_string(list_sort(list_distinct(list_filter([{hits}], lambda x: x IS NOT NULL))), ',')"


def _salary_sql(text_expr: str) -> str:
    """(match index, group list) of the first matching salary pattern."""
    pats = SALARY_RANGES
    conds, groups = [], []
    for p in pats:
        names = re.findall(r"\(\?P<(\w+)>", p)
        conds.append(f"regexp_matches({text_expr}, {q('(?i)' + p)})")
        g = []
        for want in ["currency", "min", "currency2", "max", "period"]:
            g.append(f"nullif(regexp_extract({text_expr}, {q('(?i)' + p)}, {names.index(want) + 1}), '')"
                     if want in names else "NULL")
        groups.append(g)
    return conds, groups


def salary_ctes(rows: str) -> str:
    """sal: salary of each row of the relation ``rows`` whose description has a range."""
    conds, groups = _salary_sql("description")

    def pick(i):
        return "CASE " + " ".join(f"WHEN {c} THEN {g[i]}" for c, g in zip(conds, groups)) + " END"

    cur, mn, cur2, mx, per = (pick(i) for i in range(5))

    def num(x):
        return f"TRY_CAST(replace(replace(coalesce({x}, ''), 'k', '000'), ',', '') AS DOUBLE)"

    return f"""m AS (SELECT input_seq, {cur} AS cur, {mn} AS mn, {cur2} AS cur2, {mx} AS mx, {per} AS per
      FROM {rows} WHERE {' OR '.join(conds)}),
sal AS (SELECT input_seq, {num('mn')} AS salary_min, {num('mx')} AS salary_max,
       coalesce(cur, cur2, 'USD') AS salary_currency,
       replace(lower(coalesce(per, 'year')), 'per ', '') AS salary_period,
       ({num('mn')} IS NULL OR {num('mx')} IS NULL) AS failed
FROM m)"""


def doc_salary_sql() -> str:
    return f"WITH {DOC_POSTINGS}, {salary_ctes('postings')} SELECT * FROM sal"


def clean_sql(x: str) -> str:
    inner = f"regexp_replace(coalesce({x}, ''), {q(r'[\p{C}\p{Zl}\p{Zp}]|[^\P{Zs} ]')}, '', 'g')"
    return f"trim(regexp_replace({inner}, ' {{2,}}', ' ', 'g'), ' ')"


def listing_ids_sql() -> str:
    attr, tag, sep, part = PAGE_LINKS["attr"], PAGE_LINKS["tag"], PAGE_LINKS["sep"], PAGE_LINKS["part"]
    item_re = r"(?s)<li\b[^>]*>(.*?)</li>"
    val_re = rf'(?s)<{tag}\b[^>]*\b{attr}="([^"]*)"'
    return f"""WITH items AS (
  SELECT page_id, regexp_extract_all(html, {q(item_re)}, 1) AS its FROM pages),
flat AS (SELECT page_id, unnest(its) AS item, unnest(range(0, len(its))) AS item_pos FROM items),
vals AS (SELECT page_id, item_pos, regexp_extract(item, {q(val_re)}, 1) AS v FROM flat)
SELECT page_id, item_pos, string_split(v, {q(sep)})[{part + 1}] AS listing_id
FROM vals WHERE v <> '' AND len(string_split(v, {q(sep)})) >= {part + 1}"""


def page_fields_sql() -> str:
    def first(tag):
        return f"nullif(regexp_extract(html, {q(rf'(?s)<{tag}\b[^>]*>(.*?)</{tag}>')}, 1), '')"
    return f"SELECT page_id, {first('title')} AS page_title, {first('h1')} AS h1, {first('p')} AS first_p FROM pages"


def page_details_sql() -> str:
    """Texts of the first title, h1 and paragraph outside scripts, styles and comments; the given pages have no other field."""
    bare = f"regexp_replace(html, {q(r'(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->')}, '', 'g')"

    def first(tag):
        inner = f"regexp_extract(m, {q(rf'(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>')}, 1)"
        text = f"trim(regexp_replace(regexp_replace({inner}, '<[^>]*>', ' ', 'g'), '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ')"
        for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
            text = f"replace({text}, {q(name)}, {q(char)})"
        return f"CASE WHEN regexp_matches(m, {q(rf'(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>')}) THEN {text} END AS {'page_title' if tag == 'title' else 'first_p' if tag == 'p' else tag}"
    none = ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in ("company", "job_title", "level", "location", "description", "posted_at", "updated_at", "crawled_at",
                                                               "job_function", "employment_type", "applicants", "industries"))
    return f"SELECT page_id, CAST(page_id AS VARCHAR) AS job_id, {none}, {first('title')}, {first('h1')}, {first('p')} FROM (SELECT page_id, {bare} AS m FROM pages)"


def posted_date_sql() -> str:
    pr = "substr(o_orderpriority, 1, 1)"
    txt = (f"CASE {pr} WHEN '1' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') "
           f"WHEN '2' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '+00:00' "
           f"WHEN '3' THEN strftime(o_orderdate, '%Y-%-m-%-d') "
           f"WHEN '4' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') "
           f"ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' END")
    cut = "split_part(date_posted, '+', 1)"
    parsed = (f"coalesce(try_strptime({cut}, '%Y-%m-%dT%H:%M:%S.%f'), try_strptime({cut}, '%Y-%m-%d %H:%M:%S'), "
              f"try_strptime({cut}, '%Y-%m-%d'))")
    return (f"SELECT input_seq, date_posted, CAST({parsed} AS DATE) AS posted_date FROM "
            f"(SELECT o_orderkey AS input_seq, {txt} AS date_posted FROM orders)")


def doc_text_scores(title: str, description: str) -> tuple[str, str]:
    """(cosine, description score) of a document posting."""
    clean = f"regexp_replace(lower({title} || ' ' || {description}), {q('[^' + WORD[1:-1] + WS[1:-1] + ']')}, ' ', 'g')"
    stop = "[" + ", ".join(q(w) for w in config.STOP_WORDS) + "]"
    tokens = f"list_filter(regexp_extract_all({clean}, {q(WORD + '{2,}')}), lambda t: NOT list_contains({stop}, t))"
    cos = orders.cosine(tokens, DOC_MUST, DOC_NICE, DOC_KEYWORDS, config.STOP_WORDS)
    score = (f"greatest(0.0, least(1.0, (CAST({cos} AS DOUBLE) * 0.6::DOUBLE + {orders.share(clean, DOC_KEYWORDS)} * 0.4::DOUBLE) "
             f"* (1.0::DOUBLE - {orders.share(clean, DOC_EXCLUDED)} * 0.7::DOUBLE)))")
    return cos, score


def doc_rejects_cte() -> str:
    """valid: rows that pass validation and are the first of their signature; sal: the salary of
    the LinkedIn-shaped ones (English), parsed from the description."""
    sig = "md5(concat_ws('|', " + ", ".join(strip(f"lower(coalesce({c}, ''))") for c in ("title", "description", "url")) + "))"
    return f"""{DOC_POSTINGS},
tagged AS (SELECT *, {reject_reason_sql()} AS reject_reason FROM postings),
signed AS (SELECT input_seq, {sig} AS signature FROM tagged WHERE reject_reason IS NULL),
valid AS (SELECT * FROM tagged WHERE reject_reason IS NULL AND input_seq IN (SELECT min(input_seq) FROM signed GROUP BY signature)),
english AS (SELECT * FROM valid WHERE source = 'linkedin'),
{salary_ctes('english')}"""


def flagship_sql() -> str:
    dims = {"t": clean_sql("title"), "d": clean_sql("description")}
    _, desc = doc_text_scores(dims["t"], dims["d"])
    hits = doc_skills_sql("description", DOC_DICTIONARY).replace("array_to_string(", "").rsplit(", ',')", 1)[0]
    iso = "CASE salary_currency WHEN '$' THEN 'USD' WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' ELSE salary_currency END"
    conv = f"(coalesce(salary_min, 0) * CASE {iso} WHEN 'EUR' THEN 1.1::DOUBLE WHEN 'GBP' THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END)"
    m = DOC_MIN_SALARY
    tier = (f"CASE WHEN coalesce(salary_min, 0) = 0 AND coalesce(salary_max, 0) = 0 THEN 0.5 WHEN {conv} >= {m} * 1.5 THEN 1.0 WHEN {conv} >= {m} * 1.2 THEN 0.9 "
            f"WHEN {conv} >= {m} THEN 0.8 WHEN {conv} >= {m} * 0.8 THEN 0.6 WHEN {conv} > 0 THEN 0.4 ELSE 0.5 END")
    skill = orders.SKILL.format(m=orders.skill_share(DOC_MUST, False), n=orders.skill_share(DOC_NICE, False))
    return f"""WITH {doc_rejects_cte()},
rows_ AS (SELECT v.*, {hits} AS skills, salary_min, salary_max, salary_currency FROM valid v LEFT JOIN sal USING (input_seq) WHERE failed IS NOT TRUE),
parts AS (SELECT input_seq, CASE source WHEN 'indeed' THEN 'unknown' ELSE source END AS source, {skill} AS skill_score, 1.0::DOUBLE AS location_score,
  CAST({tier} AS DOUBLE) AS salary_score, 0.5::DOUBLE AS company_score, {desc} AS description_score FROM rows_),
scored AS (SELECT *, {orders.MATCH} AS match_score FROM parts)
SELECT input_seq, source, {orders.R} FROM (SELECT * FROM scored ORDER BY match_score DESC, input_seq LIMIT 20)"""


def dictionary_table_sql() -> str:
    """Terms that end at word boundaries: every stretch of the text from a boundary to a boundary with one or two words is
    compared with the terms as text; the listed ones by their patterns."""
    padded = "(' ' || lower(coalesce(text, '')) || ' ')"
    hits = ", ".join(f"CASE WHEN regexp_matches({padded}, {q(_word_pattern(t))}) THEN {q(t)} END" for t in DOC_DICTIONARY)
    ahead = ", ".join(["x"] + [f"lead(x, {k}) OVER o" for k in range(1, 13)])  # terms have fewer words and marks
    return f"""WITH w AS (SELECT string_split(lower(text), ' ') AS w FROM benchmark),
terms AS MATERIALIZED (SELECT DISTINCT term FROM (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w) WHERE term <> ''),
parts AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {q(WORD + '+|' + NON_WORD)}) AS p FROM documents),
flat AS (SELECT doc_id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM parts),
spots AS (SELECT doc_id, i, x, regexp_matches(x, {q('^' + WORD)}) AS word, lag(regexp_matches(x, {q('^' + WORD)})) OVER o AS before, [{ahead}] AS p FROM flat WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
-- a term may begin at a word, or at another character after a word; it ends at a word, or at another character before one
tl AS (SELECT term, regexp_extract_all(term, {q(WORD + '+|' + NON_WORD)}) AS p FROM terms),
cand AS (SELECT a.doc_id, tl.term, len(tl.p) AS n, a.p FROM spots a JOIN tl ON tl.p[1] = a.x AND (a.word OR a.before)),
found AS (SELECT DISTINCT doc_id, term FROM cand WHERE array_to_string(p[1:n], '') = term
  AND (regexp_matches(p[n], {q('^' + WORD)}) OR coalesce(regexp_matches(p[n + 1], {q('^' + WORD)}), false))),
usual AS (SELECT doc_id, unnest(list_filter([{hits}], lambda x: x IS NOT NULL)) AS term FROM documents),
both_ AS (SELECT * FROM found UNION SELECT * FROM usual),
l AS (SELECT doc_id, list(term ORDER BY term) AS t FROM both_ GROUP BY doc_id)
SELECT doc_id AS input_seq, CAST(coalesce(len(t), 0) AS INT) AS n_skills, md5(coalesce(array_to_string(t, ','), '')) AS skills_md5 FROM documents LEFT JOIN l USING (doc_id)"""


def profile_table_sql() -> str:
    """Every profile against every posting, by comparing all."""
    hits = doc_skills_sql("description", DOC_DICTIONARY).replace("array_to_string(", "").rsplit(", ',')", 1)[0]
    stop = "[" + ", ".join(q(w) for w in config.STOP_WORDS) + "]"
    text = f"regexp_replace(lower({clean_sql('title')} || ' ' || {clean_sql('description')}), {q('[^' + WORD[1:-1] + WS[1:-1] + ']')}, ' ', 'g')"
    tokens = lambda x: f"list_filter(regexp_extract_all({x}, {q(WORD + '{2,}')}), lambda t: NOT list_contains({stop}, t))"
    grams = lambda tk: f"list_concat({tk}, list_transform(range(1, len({tk})), lambda i: {tk}[i] || ' ' || {tk}[i + 1]))"
    part = lambda terms, test: f"CAST(len(list_filter({terms}, lambda t: {test})) AS DOUBLE)"
    share = lambda terms, test: f"CASE WHEN len({terms}) = 0 THEN 1.0::DOUBLE ELSE {part(terms, test)} / len({terms}) END"
    skill = "len(list_filter(skills, lambda s: contains(s, t))) > 0"
    p = "min_salary"
    weights = [("skill_score", 0.4, 0.0, 0.3), ("location_score", 0.2, 0.0, 0.1), ("salary_score", 0.2, 1.0, 0.2), ("company_score", 0.1, 0.0, 0.1), ("description_score", 0.1, 0.0, 0.3)]
    match = " + ".join(f"{c} * CASE pid % 5 WHEN 0 THEN {a}::DOUBLE WHEN 1 THEN {b}::DOUBLE ELSE {o}::DOUBLE END" for c, a, b, o in weights)
    return f"""WITH {doc_rejects_cte()},
rows_ AS MATERIALIZED (SELECT input_seq, {text} AS clean, {hits} AS skills, salary_min, salary_max,
  coalesce(salary_min, 0) * CASE salary_currency WHEN '€' THEN 1.1::DOUBLE WHEN 'EUR' THEN 1.1::DOUBLE WHEN '£' THEN 1.3::DOUBLE WHEN 'GBP' THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END AS conv
  FROM valid v LEFT JOIN sal USING (input_seq) WHERE failed IS NOT TRUE),
w AS (SELECT doc_id AS pid, regexp_extract_all(lower(text), '[a-z]{{8,}}') AS w FROM documents),
prof AS MATERIALIZED (SELECT pid, CASE WHEN pid % 50 = 0 THEN ['de', 'la'] ELSE w[1:2] END AS must, CASE WHEN pid % 50 = 0 THEN ['und', 'tion'] ELSE w[3:4] END AS nice,
  w[5:7] AS kw, w[8:8] AS ex, (pid % 7) * 1000::DOUBLE AS min_salary FROM w),
voc AS (SELECT pid, {tokens("array_to_string(list_concat(must, nice, kw), ' ')")} AS tk FROM prof),
vc AS (SELECT pid, g, count(*) AS c FROM (SELECT pid, unnest({grams('tk')}) AS g FROM voc) GROUP BY ALL),
vec AS MATERIALIZED (SELECT pid, g, c / sqrt(sum(c * c) OVER (PARTITION BY pid)) AS wt FROM vc),
ptk AS (SELECT input_seq, {tokens('clean')} AS tk FROM rows_),
tf AS (SELECT input_seq, g, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT input_seq, unnest({grams('tk')}) AS g FROM ptk) WHERE g IN (SELECT g FROM vec) GROUP BY ALL),
dots AS (SELECT pid, input_seq, list(tf * wt ORDER BY g) AS d, list(tf * tf ORDER BY g) AS n FROM tf JOIN vec USING (g) GROUP BY ALL),
cos AS (SELECT pid, input_seq, list_reduce(list_concat([0.0::DOUBLE], d), lambda a, x: a + x) / sqrt(list_reduce(list_concat([0.0::DOUBLE], n), lambda a, x: a + x)) AS cosine FROM dots),
parts AS (SELECT pid, input_seq, {share('must', skill)} * 0.7::DOUBLE + {share('nice', skill)} * 0.3::DOUBLE AS skill_score,
  CASE WHEN pid % 2 = 0 THEN 1.0 WHEN pid % 8 = 1 THEN 0.0 WHEN pid % 4 = 0 THEN 0.8 ELSE 0.5 END::DOUBLE AS location_score,
  CASE WHEN coalesce(salary_min, 0) = 0 AND coalesce(salary_max, 0) = 0 THEN 0.5 WHEN conv >= {p} * 1.5::DOUBLE THEN 1.0 WHEN conv >= {p} * 1.2::DOUBLE THEN 0.9
    WHEN conv >= {p} THEN 0.8 WHEN conv >= {p} * 0.8::DOUBLE THEN 0.6 WHEN conv > 0 THEN 0.4 ELSE 0.5 END::DOUBLE AS salary_score,
  CASE pid % 3 WHEN 0 THEN 0.7 ELSE 0.5 END::DOUBLE AS company_score,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, (coalesce(cosine, 0.0) * 0.6::DOUBLE + {part('kw', 'contains(clean, t)')} / greatest(len(kw), 1) * 0.4::DOUBLE)
    * (1.0::DOUBLE - {part('ex', 'contains(clean, t)')} / greatest(len(ex), 1) * 0.7::DOUBLE))) AS description_score
  FROM prof CROSS JOIN rows_ LEFT JOIN cos USING (pid, input_seq)),
scored AS (SELECT pid, input_seq, {match} AS match_score FROM parts)
SELECT CAST(pid AS VARCHAR) AS profile, input_seq, rank, round(match_score, 6) AS match_score FROM (
  SELECT *, row_number() OVER (PARTITION BY pid ORDER BY match_score DESC, input_seq) AS rank FROM scored) WHERE rank <= 10"""


def order_skills_cte() -> str:
    """Cleaned skills of the orders adapter: part words for Upwork-shaped rows (status O)
    plus dictionary words found in the description (the sorted part names)."""
    hits = doc_skills_sql("d", ORDER_DICTIONARY).replace("array_to_string(", "").rsplit(", ',')", 1)[0]
    return f"""sk AS (
  SELECT l_orderkey, list_sort(list_distinct(flatten(list(string_split(p_name, ' '))))) AS words,
         array_to_string(list_sort(list(p_name)), ' ') AS part_text
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
po AS (SELECT o_orderkey, o_orderstatus, coalesce(part_text, '') AS d, words
       FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN sk ON o_orderkey = l_orderkey),
os AS (SELECT o_orderkey, list_distinct(list_concat(CASE WHEN o_orderstatus = 'O' THEN coalesce(words, []) ELSE [] END,
                                                    {hits})) AS skills FROM po),
items AS (SELECT unnest(skills) AS skill FROM os)"""


def oracle_sql() -> dict[str, str]:
    rr = reject_reason_sql()
    sig = "md5(concat_ws('|', " + ", ".join(strip(f"lower(coalesce({c}, ''))") for c in ("title", "description", "url")) + "))"
    valid = f"SELECT * FROM postings WHERE ({rr}) IS NULL"
    entries = {
        "F5_validate": f"WITH {DOC_POSTINGS} SELECT input_seq, {rr} AS reject_reason FROM postings",
        "A6_batch_metrics": f"WITH {DOC_POSTINGS} SELECT coalesce({rr}, 'accepted') AS outcome, count(*) AS n_rows "
                            f"FROM postings GROUP BY 1",
        "D1_dedup_exact": f"WITH {DOC_POSTINGS}, v AS ({valid}), s AS (SELECT input_seq, {sig} AS signature FROM v) "
                          f"SELECT input_seq, signature FROM s WHERE input_seq IN "
                          f"(SELECT min(input_seq) FROM s GROUP BY signature)",
        "P2_clean_text": f"WITH {DOC_POSTINGS} SELECT input_seq, {clean_sql('title')} AS title_clean, "
                         f"{clean_sql('description')} AS description_clean FROM postings",
        "P8_doc_skills": f"WITH {DOC_POSTINGS} SELECT input_seq, {doc_skills_sql('description', DOC_DICTIONARY)} AS skills "
                         f"FROM postings",
        "P11_doc_salary": doc_salary_sql,
        "F1_record_shape": "SELECT event_id, coalesce(json_type(props) = 'OBJECT' AND json_array_length(json_keys(props)) > 0, "
                           "false) AS is_record, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
        "S13_listing_ids": listing_ids_sql,
        "S14_page_fields": page_fields_sql,
        "S14_page_details": page_details_sql,
        "P7_posted_date": posted_date_sql,
        "M2_text_cosine": lambda: f"WITH {DOC_POSTINGS} SELECT input_seq, round({doc_text_scores('title', 'description')[0]}, 6) AS cosine FROM postings",
        "M4_description_score": lambda: f"WITH {DOC_POSTINGS} SELECT input_seq, round({doc_text_scores('title', 'description')[1]}, 6) AS description_score FROM postings",
        "flagship_doc_top20": flagship_sql,
        "J5_profile_table": profile_table_sql,
        "P8_dictionary_table": dictionary_table_sql,
        "F6_rejects": lambda: f"""WITH {doc_rejects_cte()} SELECT input_seq, reject_reason FROM tagged WHERE reject_reason IS NOT NULL
            UNION ALL SELECT input_seq, 'salary_unparsable' FROM sal WHERE failed""",
        "A6_stage_metrics": lambda: f"""WITH {doc_rejects_cte()}, n AS (SELECT (SELECT count(*) FROM tagged) AS a, (SELECT count(*) FROM tagged WHERE reject_reason IS NULL) AS b,
            (SELECT count(*) FROM valid) AS c, (SELECT count(*) FROM sal WHERE failed) AS d)
            SELECT 'validate' AS stage, a AS n_in, b AS n_out, a - b AS n_dropped FROM n UNION ALL SELECT 'dedup', b, c, b - c FROM n
            UNION ALL SELECT 'normalize', c, c - d, d FROM n""",
        "A6_observed": lambda: f"""WITH {doc_rejects_cte()}, n AS (SELECT (SELECT count(*) FROM tagged) AS a, (SELECT count(*) FROM tagged WHERE reject_reason IS NULL) AS b,
            (SELECT count(*) FROM valid) AS c, (SELECT count(*) FROM sal WHERE failed) AS d, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS o,
            (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 OR o_orderkey % 19 = 0) AS r)
            SELECT 'validate' AS stage, a AS n_in, b AS n_out, a - b AS n_dropped FROM n UNION ALL SELECT 'dedup', b, c, b - c FROM n
            UNION ALL SELECT 'normalize', c, c - d, d FROM n UNION ALL SELECT 'convert', o, o - r, r FROM n UNION ALL SELECT 'load', o - r, o - r, 0 FROM n""",
        # Only LinkedIn-shaped rows (status F) carry 'linkedin' (url, linkedin_* fields);
        # Upwork-shaped rows (status O) have a client and an upwork.com url.
        "P1_source": "SELECT o_orderkey AS input_seq, CASE o_orderstatus WHEN 'F' THEN 'linkedin' "
                     "WHEN 'O' THEN 'upwork' ELSE 'unknown' END AS source "
                     "FROM orders JOIN customer ON o_custkey = c_custkey",
        "A5_skill_frequency": f"WITH {order_skills_cte()} SELECT skill, count(*) AS n_jobs FROM items GROUP BY skill",
        "T5_top_skills": f"WITH {order_skills_cte()} SELECT skill, count(*) AS n_jobs FROM items GROUP BY skill "
                         f"ORDER BY n_jobs DESC, skill LIMIT 15",
        "A7_distinct_skills": f"WITH {order_skills_cte()} SELECT DISTINCT skill FROM items WHERE skill IS NOT NULL",
    }
    entries.update(orders.ORACLE)
    out = {}
    for name, entry in entries.items():  # one that fails must not take the others with it
        try:
            out[name] = entry() if callable(entry) else entry
        except Exception as e:  # noqa: BLE001
            warnings.warn(f"no SQL for {name}: {e}", stacklevel=2)
    return out
