"""DuckDB SQL for the queries over the orders adapter, written from the rules and the
adapter's shapes alone: no value or pattern is taken from the engine.

The adapter gives status F rows the LinkedIn shape, O rows the Upwork shape and P rows
neither; the order priority's first digit picks the shape of salary and date texts.
Expected results per shape are stated in closed form (``5-LOW`` rows have no salary, a
time with a zone letter is no date, and so on).
"""

from __future__ import annotations

from collections import Counter

# The query profile and dictionary, restated.
MUST, NICE = ["ring", "widget", "gear"], ["red", "blue", "gizmo", "anvil"]
KEYWORDS, EXCLUDED = ["ring", "widget", "small", "hot gear", "red"], ["bolt", "cold"]
COUNTRIES, REGIONS = ["nation_1", "nation_7", "europe"], ["asia"]
MIN_SALARY = 200000
COMPANY_TERMS = [["household"], ["machinery", "automobile"], ["building", "furniture"]]
DICTIONARY = ["ring", "gear", "plate", "rod", "anvil", "hot gear"]
RUN_DATE = "2025-01-01"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_of(x: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(t)})" for t in terms) + ")"


def share(x: str, terms: list[str]) -> str:
    """Share of the terms that are a substring of ``x``."""
    return "((" + " + ".join(f"CAST(contains({x}, {q(t)}) AS INT)" for t in terms) + f") / CAST({len(terms)} AS DOUBLE))"


def skill_share(terms: list[str], exact: bool) -> str:
    test = (lambda t: f"list_contains(skills, {q(t)})") if exact else (
        lambda t: f"len(list_filter(skills, lambda s: contains(s, {q(t)}))) > 0")
    return "((" + " + ".join(f"CAST({test(t)} AS INT)" for t in terms) + f") / CAST({len(terms)} AS DOUBLE))"


def cosine(tokens: str, must=MUST, nice=NICE, keywords=KEYWORDS, stop=()) -> str:
    """Cosine of 1-/2-gram counts with the profile's, over the list of kept tokens."""
    own = [w for w in " ".join([*must, *nice, *keywords]).split() if w not in stop and len(w) > 1]
    counts = Counter(own + [f"{a} {b}" for a, b in zip(own, own[1:])])
    norm = sum(v * v for v in counts.values()) ** 0.5
    terms = sorted(counts)
    tf = [f"CAST(len(list_filter(grams, lambda g: g = {q(t)})) AS DOUBLE)" for t in terms]
    dot = "0.0::DOUBLE"
    for e, t in zip(tf, terms):
        dot = f"({dot} + {e} * {counts[t] / norm!r}::DOUBLE)"
    sq = " + ".join(f"{e} * {e}" for e in tf)
    return (f"(SELECT CASE WHEN nn > 0 THEN dd / sqrt(nn) ELSE 0.0 END FROM (SELECT {dot} AS dd, {sq} AS nn FROM "
            f"(SELECT list_concat(tk, list_transform(range(1, len(tk)), lambda i: tk[i] || ' ' || tk[i + 1])) AS grams "
            f"FROM (SELECT {tokens} AS tk))))")


WORD = "[\\p{L}\\p{N}_]"
HITS = ", ".join(f"CASE WHEN regexp_matches(' ' || lower(descr) || ' ', {q('[^\\p{L}\\p{N}_]' + t + '[^\\p{L}\\p{N}_]')}) THEN {q(t)} END"
                 for t in DICTIONARY)

CLEANED = f"""sk AS (
  SELECT l_orderkey, list_sort(list_distinct(flatten(list(string_split(p_name, ' '))))) AS words,
         array_to_string(list_sort(list(p_name)), ' ') AS part_text, count(*) AS n_lines
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
b AS (SELECT o.*, c.*, n_name, r_name, coalesce(part_text, '') AS descr, words, n_lines,
         substr(o_orderpriority, 1, 1) AS pr, o_orderstatus = 'F' AS li, o_orderstatus = 'O' AS up,
         CAST(o_orderkey AS VARCHAR) AS k, floor(o_totalprice) AS whole, floor(o_totalprice / 1000) AS hourly
  FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey LEFT JOIN sk ON o_orderkey = l_orderkey),
loc AS (SELECT *, CASE WHEN li THEN n_name || ', ' || r_name WHEN up THEN n_name WHEN c_acctbal > 8000 THEN 'Remote'
         ELSE r_name || ', ' || n_name END AS location FROM b),
cleaned AS (SELECT o_orderkey AS input_seq, k AS id, 'Order ' || o_orderpriority || ' ' || lower(c_mktsegment) AS title,
  c_name || ' ' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS company, location, descr AS description,
  CASE WHEN li THEN 'https://www.linkedin.com/jobs/view/' || k WHEN up THEN 'https://www.upwork.com/jobs/~' || k
       ELSE 'https://www.indeed.com/viewjob?jk=' || k END AS url,
  CASE WHEN li AND pr <> '5' THEN c_acctbal > 5000
       ELSE regexp_matches(lower(location || ' ' || descr), 'remote|work from home|wfh|virtual') END AS remote,
  CASE WHEN li THEN 'linkedin' WHEN up THEN 'upwork' ELSE 'unknown' END AS source,
  CASE WHEN pr IN ('1', '2', '3') THEN CAST(o_orderdate AS DATE) END AS posted_date,
  list_sort(list_distinct(list_concat(CASE WHEN up THEN coalesce(words, []) ELSE [] END,
    list_filter([{HITS}], lambda x: x IS NOT NULL)))) AS skills,
  CASE WHEN li AND pr = '2' THEN trunc(whole / 1000) * 1000 WHEN li AND pr <> '5' THEN whole
       WHEN up AND pr IN ('1', '2') AND hourly <> 0 THEN hourly WHEN up AND pr IN ('3', '4') AND whole <> 0 THEN whole END AS salary_min,
  CASE WHEN li AND pr = '2' THEN trunc(floor(o_totalprice * 1.2::DOUBLE) / 1000) * 1000 WHEN li AND pr <> '5' THEN floor(o_totalprice * 1.2::DOUBLE)
       WHEN up AND pr = '1' AND hourly <> 0 THEN hourly + 10 WHEN up AND pr = '2' AND hourly <> 0 THEN hourly
       WHEN up AND pr IN ('3', '4') AND whole <> 0 THEN whole END AS salary_max,
  CASE WHEN li THEN CASE pr WHEN '1' THEN '$' WHEN '2' THEN 'USD' WHEN '3' THEN '€' WHEN '4' THEN 'USD' END
       WHEN up AND pr IN ('1', '2') AND hourly <> 0 THEN CASE pr WHEN '2' THEN 'EUR' ELSE 'USD' END
       WHEN up AND pr IN ('3', '4') AND whole <> 0 THEN CASE pr WHEN '4' THEN 'GBP' ELSE 'USD' END END AS salary_currency,
  CASE WHEN li THEN CASE WHEN pr = '3' THEN 'hourly' WHEN pr <> '5' THEN 'year' END
       WHEN up AND pr IN ('1', '2') AND hourly <> 0 THEN 'hour' WHEN up AND pr IN ('3', '4') AND whole <> 0 THEN 'fixed' END AS salary_period,
  CASE WHEN li THEN o_orderpriority END AS employment_type, CASE WHEN li THEN c_mktsegment END AS company_size,
  CASE WHEN li THEN r_name END AS company_industry, CASE WHEN li THEN c_name || 'of' || n_name END AS company_description,
  CASE WHEN li THEN n_name END AS city,
  CASE WHEN up THEN CASE WHEN pr <> '5' THEN lower(o_orderpriority) ELSE 'Contract' END END AS job_type,
  CASE WHEN up THEN round(c_acctbal / 1000, 2) END AS client_rating, CASE WHEN up THEN n_lines END AS client_jobs_posted,
  CASE WHEN up THEN n_lines || ' weeks' END AS engagement_duration, CASE WHEN up THEN 'up to ' || (n_lines * 5) || ' hrs/week' END AS weekly_hours,
  CASE WHEN up AND pr <> '3' THEN c_mktsegment END AS category, CASE WHEN up AND pr <> '3' THEN r_name END AS category_group
  FROM loc)"""

# An ISO currency for a symbol; conversion of the minimum; tiers against the wanted minimum.
_iso = "CASE salary_currency WHEN '$' THEN 'USD' WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' ELSE salary_currency END"
_conv = f"(CASE {_iso} WHEN 'EUR' THEN coalesce(salary_min, 0) * 1.1::DOUBLE WHEN 'GBP' THEN coalesce(salary_min, 0) * 1.3::DOUBLE ELSE coalesce(salary_min, 0) END)"
SALARY = (f"CASE WHEN coalesce(salary_min, 0) = 0 AND coalesce(salary_max, 0) = 0 THEN 0.5 WHEN {_conv} >= {MIN_SALARY} * 1.5 THEN 1.0 "
          f"WHEN {_conv} >= {MIN_SALARY} * 1.2 THEN 0.9 WHEN {_conv} >= {MIN_SALARY} THEN 0.8 WHEN {_conv} >= {MIN_SALARY} * 0.8 THEN 0.6 "
          f"WHEN {_conv} > 0 THEN 0.4 ELSE 0.5 END")
SKILL = "(CAST({m} AS DOUBLE) * 0.7::DOUBLE + CAST({n} AS DOUBLE) * 0.3::DOUBLE)"
_words = f"regexp_extract_all(regexp_replace(lower(title || ' ' || description), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), {q(WORD + '{2,}')})"
_clean = "regexp_replace(lower(title || ' ' || description), '[^\\p{L}\\p{N}_\\s]', ' ', 'g')"
_company = " + ".join(f"CAST({any_of('lower(company)', t)} AS INT)" for t in COMPANY_TERMS)


def location(exclusions: bool) -> str:
    region = f"WHEN {any_of('lower(location)', REGIONS)} THEN 0.0 " if exclusions else ""
    return f"CASE WHEN remote THEN 1.0 {region}WHEN {any_of('lower(location)', COUNTRIES)} THEN 0.8 ELSE 0.2 END"


MATCH = ("(skill_score * 0.4::DOUBLE + location_score * 0.2::DOUBLE + salary_score * 0.2::DOUBLE "
         "+ company_score * 0.1::DOUBLE + description_score * 0.1::DOUBLE)")
SCORED = f"""{CLEANED},
parts AS (SELECT *, {SKILL.format(m=skill_share(MUST, False), n=skill_share(NICE, False))} AS skill_score,
  CAST({location(True)} AS DOUBLE) AS location_score, CAST({SALARY} AS DOUBLE) AS salary_score,
  0.5::DOUBLE + CAST({_company} AS DOUBLE) / 3.0::DOUBLE * 0.5::DOUBLE AS company_score,
  greatest(0.0, least(1.0, (CAST({cosine(_words)} AS DOUBLE) * 0.6::DOUBLE + {share(_clean, KEYWORDS)} * 0.4::DOUBLE)
           * (1.0::DOUBLE - {share(_clean, EXCLUDED)} * 0.7::DOUBLE))) AS description_score
  FROM cleaned),
scored AS (SELECT *, {MATCH} AS match_score FROM parts)"""
SIMPLE = f"""{CLEANED},
parts AS (SELECT *, {SKILL.format(m=skill_share(MUST, True), n=skill_share(NICE, True))} AS skill_score,
  CAST({location(False)} AS DOUBLE) AS location_score, CAST({SALARY} AS DOUBLE) AS salary_score, 0.7::DOUBLE AS company_score,
  greatest(0.1::DOUBLE, least(1.0::DOUBLE, {share('lower(description)', KEYWORDS)}) * (1.0::DOUBLE - {share('lower(description)', EXCLUDED)} * 0.8::DOUBLE)) AS description_score
  FROM cleaned),
scored AS (SELECT *, {MATCH} AS match_score FROM parts)"""

SCORES = ["match_score", "skill_score", "location_score", "salary_score", "company_score", "description_score"]
R = ", ".join(f"round({c}, 6) AS {c}" for c in SCORES)
ORDER = "match_score DESC, input_seq"
SAL = "salary_min, salary_max, salary_currency, salary_period"
_listed = f"""{SCORED},
listed AS (SELECT row_number() OVER (ORDER BY {ORDER}) AS id, input_seq, id AS external_id, title, description, source, url,
  coalesce(posted_date, DATE '{RUN_DATE}') AS posted_date, coalesce(job_type, '') AS job_type, coalesce(employment_type, '') AS employment_type,
  remote, location, coalesce(city, '') AS city, '' AS country, {SAL}, {R}, skills, client_jobs_posted, client_rating, engagement_duration,
  weekly_hours FROM scored),
dim AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT unnest(skills) AS name FROM listed) WHERE name IS NOT NULL)"""
_criteria = [(t, loc_) for t in ("order 1-urgent", "order 3-medium") for loc_ in ("EUROPE", "NATION_1")]
_search = " UNION ALL ".join(
    f"SELECT {q(f'{t} @ {c}')} AS criterion, row_number() OVER (ORDER BY input_seq) AS result_pos, input_seq FROM cleaned "
    f"WHERE contains(lower(title), {q(t)}) AND contains(lower(location), {q(c.lower())}) "
    f"AND ({any_of('lower(title)', ['ring', 'widget'])} OR {any_of('lower(description)', ['ring', 'widget'])}) "
    f"QUALIFY row_number() OVER (ORDER BY input_seq) <= 100" for t, c in _criteria)
_bins = """h AS (SELECT match_score * 100 AS x FROM scored),
e AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM h),
g AS (SELECT bin, lo + bin * ((hi - lo) / 10) AS bin_lo, CASE WHEN bin = 9 THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 10) END AS bin_hi
      FROM e, (SELECT CAST(unnest(range(10)) AS INT) AS bin)),
n AS (SELECT bin, count(*) AS n_jobs FROM g JOIN h ON x >= bin_lo AND (x < bin_hi OR (bin = 9 AND x <= bin_hi)) GROUP BY bin)"""

ORACLE = {
    "P14_normalize": f"""WITH {CLEANED} SELECT input_seq, id, title, company, location, description, url, remote, source, posted_date,
        array_to_string(skills, ',') AS skills, {SAL}, employment_type, company_size, company_industry, company_description, city, job_type,
        client_rating, client_jobs_posted, engagement_duration, weekly_hours, category, category_group FROM cleaned""",
    "M9_score_full": f"WITH {SCORED} SELECT input_seq, {R} FROM scored",
    "M15_score_simple": f"WITH {SIMPLE} SELECT input_seq, {R} FROM scored",
    "T1_rank": f"WITH {SCORED} SELECT row_number() OVER (ORDER BY {ORDER}) AS rank, input_seq, round(match_score, 6) AS match_score FROM scored",
    "T2_top50": f"WITH {SCORED} SELECT input_seq, round(match_score, 6) AS match_score FROM (SELECT * FROM scored ORDER BY {ORDER} LIMIT 50)",
    "T4_notify": f"WITH {SCORED} SELECT input_seq, round(match_score, 6) AS match_score FROM (SELECT * FROM scored WHERE match_score >= 0.5 ORDER BY {ORDER} LIMIT 10)",
    "J6_not_notified": f"WITH {SCORED} SELECT input_seq, round(match_score, 6) AS match_score FROM (SELECT * FROM scored WHERE match_score >= 0.5 ORDER BY {ORDER} LIMIT 10 OFFSET 10)",
    "A1_summary": f"WITH {SCORED} SELECT count(*) AS n_jobs, round(avg(match_score), 6) AS avg_match_score FROM scored",
    "A2_sources": f"""WITH {CLEANED} SELECT source, upper(substr(source, 1, 1)) || substr(source, 2) AS source_name, count(*) AS n_jobs,
        round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS share_pct FROM cleaned GROUP BY source""",
    "A4_histogram": f"WITH {SCORED}, {_bins} SELECT g.bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, coalesce(n_jobs, 0) AS n_jobs FROM g LEFT JOIN n USING (bin)",
    "X7_display": f"""WITH {SCORED}, top AS (SELECT *, {_iso} AS iso FROM scored ORDER BY {ORDER} LIMIT 20),
        s AS (SELECT *, CASE iso WHEN 'USD' THEN '$' WHEN 'EUR' THEN '€' WHEN 'GBP' THEN '£' ELSE '' END AS sym FROM top)
        SELECT input_seq, title, round(match_score * 100, 6) AS match_pct, printf('%.1f%%', match_score * 100) AS match_text, company,
        CASE WHEN remote THEN 'Remote' ELSE location END AS location, source,
        CASE WHEN coalesce(salary_min, 0) > 0 OR coalesce(salary_max, 0) > 0 THEN CASE WHEN salary_min = salary_max THEN sym || format('{{:,}}', CAST(salary_min AS BIGINT))
          ELSE sym || format('{{:,}}', CAST(salary_min AS BIGINT)) || ' - ' || sym || format('{{:,}}', CAST(salary_max AS BIGINT)) END ELSE '' END AS salary_text,
        CASE WHEN len(skills) > 5 THEN array_to_string(skills[1:5], ', ') || ', +' || (len(skills) - 5) || ' more' ELSE array_to_string(skills, ', ') END AS skills_preview,
        url FROM s""",
    "S9_listings": f"""WITH {_listed} SELECT id, external_id, title, description, source, url, posted_date, job_type, employment_type, remote, location, city,
        country, {SAL}, {', '.join(SCORES)} FROM listed""",
    "S9_second_load": f"""WITH {SCORED}, one AS (SELECT row_number() OVER (ORDER BY {ORDER}) AS id, source, id AS external_id,
        coalesce(posted_date, DATE '2024-12-31') AS posted_date, round(match_score, 6) AS match_score FROM scored WHERE input_seq % 2 = 0),
        two AS (SELECT (SELECT count(*) FROM one) + row_number() OVER (ORDER BY {ORDER}) AS id, source, id AS external_id,
        coalesce(posted_date, DATE '{RUN_DATE}') AS posted_date, round(match_score, 6) AS match_score FROM scored WHERE input_seq % 2 <> 0)
        SELECT * FROM one UNION ALL SELECT * FROM two""",
    "S10_skills_dim": f"WITH {_listed} SELECT id, name FROM dim",
    "S11_job_skills": f"WITH {_listed}, i AS (SELECT id AS job_id, unnest(skills) AS name FROM listed) SELECT DISTINCT job_id, dim.id AS skill_id FROM i JOIN dim USING (name)",
    "S12_client_details": f"""WITH {_listed} SELECT id AS job_id, client_jobs_posted AS client_total_jobs_posted, client_rating, location AS client_country,
        engagement_duration, weekly_hours, job_type AS project_type FROM listed WHERE source = 'upwork'""",
    "S2_search": f"WITH {CLEANED} {_search}",
    "S2_indexed_search": f"""WITH {CLEANED}, kinds AS (SELECT DISTINCT 'order ' || lower(o_orderpriority) AS t FROM orders)
        SELECT t || ' @ ' || n_name AS criterion, row_number() OVER (PARTITION BY t, n_name ORDER BY input_seq) AS result_pos, input_seq
        FROM cleaned JOIN kinds ON contains(lower(title), t) JOIN nation ON contains(lower(location), lower(n_name))
        WHERE {any_of('lower(title)', ['ring', 'widget'])} OR {any_of('lower(description)', ['ring', 'widget'])}
        QUALIFY row_number() OVER (PARTITION BY t, n_name ORDER BY input_seq) <= 100""",
    "S1_json_ingest": f"""WITH {CLEANED} SELECT input_seq, source, company, location, remote, posted_date, array_to_string(skills, ',') AS skills, {SAL} FROM cleaned""",
    "S6_S7_csv_roundtrip": f"WITH {CLEANED} SELECT input_seq, id, title, source, remote, array_to_string(skills, ',') AS skills, {SAL} FROM cleaned",
    "S6_cleaned_parquet": f"WITH {CLEANED} SELECT input_seq, id, source, title, remote, posted_date, array_to_string(skills, ',') AS skills, {SAL} FROM cleaned",
    "S8_top_csv": f"""WITH {SCORED} SELECT input_seq, id AS external_id, remote, coalesce(posted_date, DATE '{RUN_DATE}') AS posted_date, salary_min, salary_currency,
        array_to_string(skills, '|') AS skills, {R} FROM (SELECT * FROM scored ORDER BY {ORDER} LIMIT 50)""",
    "S1_json_arrays": f"WITH {CLEANED} SELECT id, source, company, location, remote, posted_date, array_to_string(skills, ',') AS skills, {SAL} FROM cleaned WHERE source <> 'unknown'",
    "S4_raw_landing": f"WITH {CLEANED} SELECT id, CASE source WHEN 'unknown' THEN 'indeed' ELSE source END AS source, CAST(d AS DATE) AS load_date, title, url FROM cleaned, "
                      f"(SELECT unnest(['2025-01-01', '2025-01-02']) AS d)",
    "S5_fresh": f"WITH {CLEANED}, w AS (SELECT unnest(['fresh', 'stale', 'forced']) AS what) SELECT what, CASE what WHEN 'fresh' THEN (SELECT count(*) FROM cleaned) ELSE 0 END AS n_rows FROM w",
    "M9_own_matcher": f"""WITH {CLEANED}, s AS (SELECT input_seq, {share('lower(description)', MUST)} AS a, {share('lower(description)', KEYWORDS)} AS b, CAST(remote AS DOUBLE) AS r FROM cleaned)
        SELECT input_seq, round(a * 0.5::DOUBLE + b * 0.5::DOUBLE, 6) AS match_score, round(a, 6) AS skill_score, r AS location_score, 0.0::DOUBLE AS salary_score, 0.0::DOUBLE AS company_score,
        round(b, 6) AS description_score FROM s""",
    "S2_job_board": " UNION ALL ".join(
        f"SELECT criterion, input_seq FROM (WITH {CLEANED} SELECT {q(f'{t} @ {c}')} AS criterion, input_seq, title FROM cleaned WHERE contains(lower(title), {q(t)}) "
        f"AND contains(lower(location), {q(c.lower())}) AND ({any_of('lower(title)', ['ring', 'widget'])} OR {any_of('lower(description)', ['ring', 'widget'])}) "
        f"ORDER BY input_seq LIMIT 100) WHERE contains(title, 'building')" for t, c in _criteria),
    "X1_percent_text": f"WITH {SCORED} SELECT input_seq, printf('%.1f%%', match_score * 100) AS match_text, printf('%.1f%%', description_score * 100) AS description_text FROM scored",
    "S9_batches": f"""WITH {SCORED}, e AS (SELECT *, row_number() OVER (ORDER BY {ORDER}) AS n FROM scored WHERE input_seq % 2 = 0),
        a AS (SELECT *, row_number() OVER (ORDER BY {ORDER}) + (SELECT count(*) FROM e) AS n FROM scored)
        SELECT 'one' AS batch, n AS id, source, CAST(input_seq AS VARCHAR) AS external_id, coalesce(posted_date, DATE '2024-12-31') AS posted_date FROM e
        UNION ALL SELECT 'two', n, source, CAST(input_seq AS VARCHAR), coalesce(posted_date, DATE '{RUN_DATE}') FROM a WHERE input_seq % 2 <> 0""",
    "S9_load_rejects": f"""WITH {SCORED}, f AS (SELECT input_seq, posted_date, CASE WHEN input_seq % 11 = 0 THEN 'match_score: not a number' WHEN input_seq % 19 = 0 THEN 'match_score: not a number'
        WHEN input_seq % 13 = 0 THEN 'salary_score: out of range' WHEN input_seq % 17 = 0 THEN 'posted_date: not a date' END AS fault FROM scored)
        SELECT input_seq, coalesce(fault, 'loaded') AS status, CASE WHEN fault IS NULL THEN NULL WHEN input_seq % 11 = 0 THEN 'n/a' WHEN input_seq % 19 = 0 THEN ''
        WHEN input_seq % 13 = 0 THEN '1e20' ELSE 'soon' END AS reject_value, CASE WHEN fault IS NULL THEN coalesce(posted_date, DATE '{RUN_DATE}') END AS posted_date,
        CASE WHEN fault IS NULL THEN true END AS exact FROM f""",
    "J6_once_per_profile": f"""WITH {SCORED}, two AS (SELECT 'full' AS profile, input_seq, id, match_score FROM scored UNION ALL
        SELECT 'salary', input_seq, id, skill_score * 0.0::DOUBLE + location_score * 0.0::DOUBLE + salary_score * 1.0::DOUBLE + company_score * 0.0::DOUBLE + description_score * 0.0::DOUBLE FROM scored),
        r AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY match_score DESC, input_seq) - 1 AS n FROM two WHERE match_score >= 0.5)
        SELECT CASE WHEN n < 10 THEN 0 WHEN n < 20 THEN 1 ELSE 3 END AS turn, profile, id, CAST(n % 10 + 1 AS INT) AS rank,
        DATE '2025-01-01' + CAST(n // 10 AS INT) AS notified_on FROM r WHERE n < 30""",
    "S4_stream_dedup": f"""WITH {CLEANED}, o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders), p AS (SELECT input_seq, title, d FROM cleaned JOIN o ON k = input_seq)
        SELECT input_seq, title, d AS collected_on FROM p UNION ALL
        SELECT input_seq, title, d + 1600 FROM p WHERE input_seq % 7 = 0 AND d < DATE '1999-01-01'""",
    "J5_profiles": f"""WITH {SCORED} SELECT 'full' AS profile, input_seq, rank, round(match_score, 6) AS match_score FROM (
        SELECT *, row_number() OVER (ORDER BY {ORDER}) AS rank FROM scored) WHERE rank <= 10
        UNION ALL SELECT 'salary', input_seq, rank, round(m, 6) FROM (SELECT *, row_number() OVER (ORDER BY m DESC, input_seq) AS rank FROM
        (SELECT *, (skill_score * 0.0::DOUBLE + location_score * 0.0::DOUBLE + salary_score * 1.0::DOUBLE + company_score * 0.0::DOUBLE + description_score * 0.0::DOUBLE) AS m FROM scored)) WHERE rank <= 10""",
}
