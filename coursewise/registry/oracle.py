"""The registered queries in plain SQL, by the direct formulation.

Similarities are written as explicit pairs of learners and of resources here, so that the
pair-free forms of the library are checked against an independent statement.
"""

from __future__ import annotations

RAW = """
clicks AS (
  SELECT o_custkey AS id_student, c_mktsegment AS code_module,
         CASE WHEN year(l_shipdate) % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS code_presentation,
         CAST((CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
               WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END) * 100000
              + (year(l_shipdate) % 2) * 10000 + CAST(substr(p_brand, 7) AS INT) * 100
              + (CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                 WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END) AS BIGINT) AS id_site,
         CAST(dayofyear(l_shipdate) - 25 AS INT) AS date, CAST(l_quantity AS INT) AS sum_click,
         lower(p_type) AS activity_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey),
vle AS (
  SELECT DISTINCT id_site, code_module, code_presentation, activity_type,
         CASE WHEN id_site % 3 = 0 THEN NULL ELSE CAST(id_site % 30 AS DOUBLE) END AS week_from,
         CASE WHEN id_site % 4 = 0 THEN NULL ELSE CAST(id_site % 30 + 5 AS DOUBLE) END AS week_to
  FROM clicks),
student_vle AS (
  SELECT id_student, code_module, code_presentation, id_site, date, sum_click FROM clicks),
courses AS (
  SELECT DISTINCT code_module, code_presentation,
         240 + 5 * (CASE code_module WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                    WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END) AS module_presentation_length
  FROM clicks),
people AS (
  SELECT c_custkey AS k, r_name, n_nationkey, c_acctbal, CAST(floor(c_acctbal / 1000) AS INT) * 10 AS band
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
student_info AS (
  SELECT DISTINCT c.code_module, c.code_presentation, c.id_student,
         CASE WHEN k % 2 = 0 THEN 'F' ELSE 'M' END AS gender, r_name AS region,
         CASE k % 3 WHEN 0 THEN 'HE Qualification' WHEN 1 THEN 'A Level or Equivalent'
              ELSE 'Lower Than A Level' END AS highest_education,
         CASE WHEN c_acctbal < 0 THEN NULL
              ELSE CAST(band AS VARCHAR) || '-' || CAST(band + 10 AS VARCHAR) || '%' END AS imd_band,
         CASE n_nationkey % 3 WHEN 0 THEN '0-35' WHEN 1 THEN '35-55' ELSE '55<=' END AS age_band,
         CAST(k % 3 AS INT) AS num_of_prev_attempts, CAST(30 * (1 + k % 4) AS INT) AS studied_credits,
         CASE WHEN k % 10 = 0 THEN 'Y' ELSE 'N' END AS disability,
         CASE k % 4 WHEN 0 THEN 'Pass' WHEN 1 THEN 'Fail' WHEN 2 THEN 'Withdrawn'
              ELSE 'Distinction' END AS final_result
  FROM clicks c JOIN people ON c.id_student = k),
student_registration AS (
  SELECT code_module, code_presentation, id_student,
         CASE WHEN id_student % 50 = 0 THEN NULL ELSE CAST(id_student % 200 - 60 AS DOUBLE) END AS date_registration,
         CASE WHEN final_result = 'Withdrawn' THEN CAST(id_student % 150 AS DOUBLE) END AS date_unregistration
  FROM student_info WHERE id_student % 41 <> 0),
course_numbers AS (
  SELECT code_module, code_presentation,
         (CASE code_module WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
          WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END) * 2
         + CASE WHEN code_presentation = 'EVEN' THEN 0 ELSE 1 END AS course_no
  FROM courses),
assessments AS (
  SELECT code_module, code_presentation, CAST(course_no * 10 + digit AS BIGINT) AS id_assessment,
         CASE WHEN digit <= 2 THEN 'TMA' WHEN digit <= 4 THEN 'CMA' ELSE 'Exam' END AS assessment_type,
         CASE WHEN digit = 5 THEN NULL ELSE CAST(40 * digit AS DOUBLE) END AS date,
         CAST(10 * digit AS DOUBLE) AS weight
  FROM course_numbers JOIN (VALUES (1), (2), (3), (4), (5)) d(digit) ON TRUE),
student_assessment AS (
  SELECT CAST(((CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END) * 2 + year(o_orderdate) % 2) * 10
              + CAST(substr(o_orderpriority, 1, 1) AS INT) AS BIGINT) AS id_assessment,
         o_custkey AS id_student, CAST(dayofyear(o_orderdate) AS INT) AS date_submitted,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_banked,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey % 101 AS DOUBLE) END AS score
  FROM orders JOIN customer ON o_custkey = c_custkey),
student_merged AS (
  SELECT * FROM student_info LEFT JOIN student_registration USING (id_student, code_module, code_presentation)
  LEFT JOIN courses USING (code_module, code_presentation)),
assessment_merged AS (
  SELECT * FROM student_assessment LEFT JOIN assessments USING (id_assessment)
  LEFT JOIN courses USING (code_module, code_presentation)),
vle_merged AS (
  SELECT * FROM student_vle LEFT JOIN vle USING (id_site, code_module, code_presentation)
  LEFT JOIN courses USING (code_module, code_presentation))"""

CLEAN = """,
student_distinct AS (SELECT DISTINCT * FROM student_merged),
imd_mode AS (
  SELECT imd_band AS mode_band FROM student_distinct WHERE imd_band IS NOT NULL
  GROUP BY imd_band ORDER BY count(*) DESC, imd_band LIMIT 1),
student_clean AS (
  SELECT * REPLACE (coalesce(imd_band, (SELECT mode_band FROM imd_mode)) AS imd_band,
                    coalesce(date_unregistration, module_presentation_length) AS date_unregistration),
         coalesce(final_result = 'Withdrawn', FALSE) AS withdrew
  FROM student_distinct WHERE date_registration IS NOT NULL),
assessment_clean AS (
  SELECT * REPLACE (coalesce(date, CAST(module_presentation_length - 7 AS DOUBLE)) AS date)
  FROM (SELECT DISTINCT * FROM assessment_merged) WHERE score IS NOT NULL),
student_data AS (
  SELECT * REPLACE (CASE WHEN disability IN ('N', '') THEN FALSE ELSE TRUE END AS disability),
         date_unregistration - date_registration AS registration_duration
  FROM student_clean),
assessment_data AS (
  SELECT * REPLACE (CASE WHEN is_banked = 0 THEN FALSE ELSE TRUE END AS is_banked),
         avg(score) OVER (PARTITION BY id_student, code_module, code_presentation) AS average_score
  FROM assessment_clean),
vle_data AS (SELECT * EXCLUDE (week_from, week_to) FROM vle_merged),
resource_data AS (
  SELECT * EXCLUDE (week_from, week_to),
         coalesce(code_module, 'nan') || ' ' || coalesce(code_presentation, 'nan') || ' '
         || coalesce(activity_type, 'nan') AS resource_text
  FROM vle),
interaction_data AS (
  SELECT id_student, code_module, code_presentation, id_site, activity_type,
         CAST(sum(sum_click) AS BIGINT) AS total_resource_clicks, min(date) AS first_used,
         max(date) AS last_used, max(date) - min(date) AS click_duration
  FROM vle_data WHERE activity_type IS NOT NULL GROUP BY ALL)"""


def features_sql(name: str, cutoff: int) -> str:
    """CTEs ``<name>_assessment``, ``<name>_vle`` and ``<name>``: features at a cutoff."""
    return f""",
{name}_assessment AS (
  SELECT id_student, code_module, code_presentation, avg(score) AS average_score, min(score) AS min_score,
         max(score) AS max_score, count(id_assessment) AS assessments_submitted,
         avg(date_submitted) AS average_submission_date, avg(weight) AS average_assessment_weight,
         count(DISTINCT assessment_type) AS assessment_type_diversity
  FROM assessment_data WHERE date_submitted <= {cutoff} GROUP BY ALL),
{name}_vle AS (
  SELECT id_student, code_module, code_presentation, CAST(sum(sum_click) AS BIGINT) AS total_resource_clicks,
         avg(sum_click) AS average_resource_clicks, min(date) AS first_used, max(date) AS last_used,
         count(DISTINCT id_site) AS resources_used, max(date) - min(date) AS interaction_duration
  FROM vle_data WHERE date <= {cutoff} GROUP BY ALL),
{name} AS (
  SELECT s.* EXCLUDE (registration_duration, final_result, withdrew, date_unregistration),
         coalesce(average_score, 0) AS average_score, coalesce(min_score, 0) AS min_score,
         coalesce(max_score, 0) AS max_score, coalesce(assessments_submitted, 0) AS assessments_submitted,
         coalesce(average_submission_date, 0) AS average_submission_date,
         coalesce(average_assessment_weight, 0) AS average_assessment_weight,
         coalesce(assessment_type_diversity, 0) AS assessment_type_diversity,
         coalesce(total_resource_clicks, 0) AS total_resource_clicks,
         coalesce(average_resource_clicks, 0) AS average_resource_clicks, coalesce(first_used, 0) AS first_used,
         coalesce(last_used, 0) AS last_used, coalesce(resources_used, 0) AS resources_used,
         coalesce(interaction_duration, 0) AS interaction_duration, {cutoff} - date_registration AS days_registered
  FROM student_data s LEFT JOIN {name}_assessment USING (id_student, code_module, code_presentation)
  LEFT JOIN {name}_vle USING (id_student, code_module, code_presentation)
  WHERE date_registration <= {cutoff})"""


def scores_sql(folds: list[tuple]) -> str:
    """CTEs of all scores per fold; a fold is (fold, cutoff_day, test_end or None)."""
    rows = ", ".join(f"({f}, {c}, {'NULL' if e is None else e})" for f, c, e in folds)
    return f""",
folds AS (SELECT fold, cutoff_day, CAST(test_end AS INT) AS test_end FROM (VALUES {rows}) f(fold, cutoff_day, test_end)),
hist AS MATERIALIZED (
  SELECT fold, id_student, code_module, code_presentation, id_site, activity_type,
         sum(sum_click) AS clicks
  FROM vle_data JOIN folds ON date <= cutoff_day AND (test_end IS NULL OR date <= test_end)
  WHERE activity_type IS NOT NULL GROUP BY ALL),
fut AS MATERIALIZED (
  SELECT DISTINCT fold, id_student, code_module, code_presentation, id_site
  FROM vle_data JOIN folds ON date > cutoff_day AND (test_end IS NULL OR date <= test_end)
  WHERE activity_type IS NOT NULL),
lc AS (SELECT DISTINCT fold, id_student, code_module, code_presentation FROM hist),
used AS (SELECT DISTINCT fold, id_student, id_site FROM hist),
items AS (
  SELECT fold, id_site, code_module, code_presentation, activity_type, CAST(sum(clicks) AS DOUBLE) AS raw
  FROM hist GROUP BY ALL),
pop_raw AS MATERIALIZED (
  SELECT fold, id_student, id_site, code_module, code_presentation, activity_type, raw
  FROM lc JOIN items USING (fold, code_module, code_presentation)
  ANTI JOIN used USING (fold, id_student, id_site)),
pop_top AS (SELECT fold, id_student, max(raw) AS top FROM pop_raw GROUP BY ALL),
pop AS MATERIALIZED (
  SELECT * EXCLUDE (raw, top), CASE WHEN top > 0 THEN raw / top ELSE raw END AS popularity_score
  FROM pop_raw JOIN pop_top USING (fold, id_student)),
random_list AS (
  SELECT fold, id_student, id_site, code_module, code_presentation, activity_type,
         CAST(CAST('0x' || substr(md5('10:' || id_student || ':' || id_site), 1, 8) AS BIGINT) AS DOUBLE)
         / 4294967296.0 AS random_score
  FROM pop_raw),
sets AS MATERIALIZED (
  SELECT fold, id_student,
         string_agg(code_module || '|' || code_presentation, ';' ORDER BY code_module, code_presentation) AS course_set
  FROM lc GROUP BY fold, id_student),
set_courses AS (
  SELECT DISTINCT fold, course_set, code_module, code_presentation FROM sets JOIN lc USING (fold, id_student)),
cells AS MATERIALIZED (
  SELECT fold, course_set, id_student, id_site, CAST(avg(clicks) AS DOUBLE) AS v
  FROM set_courses JOIN hist USING (fold, code_module, code_presentation) GROUP BY ALL),
units AS MATERIALIZED (
  SELECT *, CASE WHEN sum(v * v) OVER w > 0 THEN v / sqrt(sum(v * v) OVER w) ELSE 0 END AS u
  FROM cells WINDOW w AS (PARTITION BY fold, course_set, id_student)),
own AS MATERIALIZED (SELECT units.* FROM units JOIN sets USING (fold, id_student, course_set)),
learner_pairs AS MATERIALIZED (
  SELECT a.fold, a.course_set, a.id_student AS learner, b.id_student AS neighbour, sum(a.u * b.u) AS cosine
  FROM own a JOIN units b ON a.fold = b.fold AND a.course_set = b.course_set AND a.id_site = b.id_site
       AND a.id_student <> b.id_student
  GROUP BY ALL),
collab_raw AS (
  SELECT p.fold, p.course_set, learner AS id_student, c.id_site, sum(cosine * c.v) AS raw
  FROM learner_pairs p JOIN cells c
       ON c.fold = p.fold AND c.course_set = p.course_set AND c.id_student = neighbour
  GROUP BY ALL),
collab_kept AS MATERIALIZED (
  SELECT r.* FROM collab_raw r
  ANTI JOIN (SELECT * FROM own WHERE v <> 0) u
       ON u.fold = r.fold AND u.id_student = r.id_student AND u.id_site = r.id_site
  WHERE raw > 0),
details AS (
  SELECT DISTINCT fold, course_set, id_site, code_module, code_presentation, activity_type
  FROM set_courses JOIN hist USING (fold, code_module, code_presentation)),
collab_top AS (SELECT fold, id_student, max(raw) AS top FROM collab_kept GROUP BY ALL),
collab AS MATERIALIZED (
  SELECT fold, id_student, id_site, code_module, code_presentation, activity_type,
         raw / top AS collaborative_score
  FROM collab_kept JOIN collab_top USING (fold, id_student) LEFT JOIN details USING (fold, course_set, id_site)),
catalogue AS (
  SELECT fold, course_set, id_site, code_module, code_presentation, activity_type, resource_text
  FROM set_courses JOIN resource_data USING (code_module, code_presentation)
  QUALIFY row_number() OVER (PARTITION BY fold, course_set, id_site
                             ORDER BY code_module, code_presentation, activity_type) = 1),
tokens AS (
  SELECT fold, course_set, id_site,
         unnest(regexp_extract_all(lower(resource_text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term
  FROM catalogue),
tf AS (SELECT fold, course_set, id_site, term, count(*) AS tf FROM tokens GROUP BY ALL),
df AS (SELECT fold, course_set, term, count(*) AS df FROM tf GROUP BY ALL),
docs AS (SELECT fold, course_set, count(*) AS n FROM catalogue GROUP BY ALL),
weighted AS (
  SELECT fold, course_set, id_site, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w
  FROM tf JOIN df USING (fold, course_set, term) JOIN docs USING (fold, course_set)),
vectors AS MATERIALIZED (
  SELECT * REPLACE (w / sqrt(sum(w * w) OVER (PARTITION BY fold, course_set, id_site)) AS w) FROM weighted),
resource_pairs AS MATERIALIZED (
  SELECT a.fold, a.course_set, a.id_site AS site, b.id_site AS other, sum(a.w * b.w) AS cosine
  FROM vectors a JOIN vectors b ON a.fold = b.fold AND a.course_set = b.course_set AND a.term = b.term
  GROUP BY ALL),
used_by_set AS MATERIALIZED (
  SELECT fold, course_set, id_student, id_site FROM used JOIN sets USING (fold, id_student)),
content_raw AS (
  SELECT s.fold, s.course_set, s.id_student, p.site AS id_site, sum(cosine) AS raw
  FROM used_by_set s JOIN resource_pairs p
       ON p.fold = s.fold AND p.course_set = s.course_set AND p.other = s.id_site
  GROUP BY ALL),
content_kept AS MATERIALIZED (
  SELECT * FROM content_raw ANTI JOIN used USING (fold, id_student, id_site) WHERE raw > 0),
content_top AS (SELECT fold, id_student, max(raw) AS top FROM content_kept GROUP BY ALL),
content AS MATERIALIZED (
  SELECT fold, id_student, id_site, code_module, code_presentation, activity_type, raw / top AS content_score
  FROM content_kept JOIN content_top USING (fold, id_student) JOIN catalogue USING (fold, course_set, id_site)),
stacked AS (
  SELECT * EXCLUDE (popularity_score), popularity_score AS p, NULL AS c, NULL AS n FROM pop
  UNION ALL BY NAME SELECT * EXCLUDE (content_score), content_score AS c FROM content
  UNION ALL BY NAME SELECT * EXCLUDE (collaborative_score), collaborative_score AS n FROM collab),
hybrid AS MATERIALIZED (
  SELECT fold, id_student, id_site, code_module, code_presentation, activity_type,
         coalesce(max(p), 0) AS popularity_score, coalesce(max(c), 0) AS content_score,
         coalesce(max(n), 0) AS collaborative_score,
         0.4::DOUBLE * coalesce(max(p), 0) + 0.2::DOUBLE * coalesce(max(c), 0)
         + 0.4::DOUBLE * coalesce(max(n), 0) AS hybrid_score
  FROM stacked GROUP BY ALL),
lists AS MATERIALIZED (
  SELECT fold, id_student, code_module, code_presentation, id_site, 'popularity' AS recommender, popularity_score AS score FROM pop
  UNION ALL SELECT fold, id_student, code_module, code_presentation, id_site, 'collaborative', collaborative_score FROM collab
  UNION ALL SELECT fold, id_student, code_module, code_presentation, id_site, 'content', content_score FROM content
  UNION ALL SELECT fold, id_student, code_module, code_presentation, id_site, 'hybrid', hybrid_score FROM hybrid
  UNION ALL SELECT fold, id_student, code_module, code_presentation, id_site, 'random', random_score FROM random_list),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY fold, recommender, id_student, code_module, code_presentation
                               ORDER BY round(score, 9) DESC, id_site) AS position
  FROM lists),
best AS MATERIALIZED (SELECT * FROM ranked WHERE position <= 20),
relevant AS MATERIALIZED (
  SELECT * FROM fut ANTI JOIN (SELECT DISTINCT fold, id_student, code_module, code_presentation, id_site FROM hist) h
  USING (fold, id_student, code_module, code_presentation, id_site)),
spine AS (
  SELECT fold, id_student, code_module, code_presentation, count(*) AS n_relevant
  FROM relevant SEMI JOIN lc USING (fold, id_student, code_module, code_presentation) GROUP BY ALL),
recommenders AS (SELECT * FROM (VALUES ('popularity'), ('collaborative'), ('content'), ('hybrid'), ('random')) r(recommender)),
hits AS (
  SELECT fold, recommender, id_student, code_module, code_presentation, count(*) AS hits
  FROM best JOIN relevant USING (fold, id_student, code_module, code_presentation, id_site) GROUP BY ALL),
measured AS (
  SELECT fold, id_student, code_module, code_presentation, recommender, n_relevant, coalesce(hits, 0) AS hits,
         coalesce(hits, 0) / 20.0::DOUBLE AS precision, coalesce(hits, 0) / n_relevant::DOUBLE AS recall
  FROM spine CROSS JOIN recommenders
  LEFT JOIN hits USING (fold, id_student, code_module, code_presentation, recommender)),
metrics AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM measured)"""


CANDIDATES = """,
source_ranked AS (
  SELECT * FROM ranked WHERE recommender IN ('popularity', 'collaborative', 'content') AND position <= 20),
pool AS (
  SELECT fold, id_student, code_module, code_presentation, id_site,
         coalesce(max(CASE WHEN recommender = 'popularity' THEN score END), 0) AS popularity_score,
         coalesce(max(CASE WHEN recommender = 'collaborative' THEN score END), 0) AS collaborative_score,
         coalesce(max(CASE WHEN recommender = 'content' THEN score END), 0) AS content_score
  FROM source_ranked GROUP BY ALL),
candidates AS (
  SELECT * FROM pool LEFT JOIN resource_data USING (id_site, code_module, code_presentation)),
both_sides AS (
  SELECT * FROM lc SEMI JOIN fut USING (fold, id_student, code_module, code_presentation)),
labelled AS (
  SELECT c.*, CASE WHEN r.id_site IS NULL THEN 0 ELSE 1 END AS target
  FROM candidates c SEMI JOIN both_sides USING (fold, id_student, code_module, code_presentation)
  LEFT JOIN relevant r USING (fold, id_student, code_module, code_presentation, id_site)
  WHERE resource_text IS NOT NULL)"""

ML = CANDIDATES + """,
ml_dataset AS (
  SELECT * FROM labelled LEFT JOIN learner_features USING (id_student, code_module, code_presentation))"""

HOLDOUT = [(0, 150, None)]
FOLDS = [(1, 60, 120), (2, 120, 180), (3, 180, 240)]
LC = "id_student, code_module, code_presentation"
ITEM = "id_site, code_module, code_presentation, activity_type"


def _prepared(select: str) -> str:
    return f"WITH {RAW}{CLEAN}\n{select}"


def _scored(select: str, folds=HOLDOUT, extra: str = "") -> str:
    return f"WITH {RAW}{CLEAN}{scores_sql(folds)}{extra}\n{select}"


def _ml(select: str) -> str:
    return _scored(select, extra=features_sql("learner_features", 150) + ML)


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


FEATURES = (
    "average_score, min_score, max_score, assessments_submitted, average_submission_date, "
    "average_assessment_weight, assessment_type_diversity, total_resource_clicks, average_resource_clicks, "
    "first_used, last_used, resources_used, interaction_duration, days_registered"
)
NUMERIC = ["popularity_score", "collaborative_score", "content_score", "num_of_prev_attempts", "studied_credits",
           *FEATURES.replace(" ", "").split(",")]
ROUNDED = {"average_score", "average_submission_date", "average_assessment_weight", "average_resource_clicks"}
PERSON = ("gender, region, highest_education, imd_band, age_band, num_of_prev_attempts, studied_credits, disability, "
          "date_registration, module_presentation_length")


def _rounded_list(columns: str) -> str:
    return ", ".join(
        f"round({c}, 6) AS {c}" if c in ROUNDED or c.endswith("_score") else c
        for c in columns.replace(" ", "").split(",")
    )


def _melted(table: str, columns: list[str], kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS {kind}) AS value FROM {table}" for c in columns
    )


def _histogram(table: str, column: str, name: str) -> str:
    return f"""
SELECT '{name}' AS histogram, CAST(b.bin AS BIGINT) AS bin, round(lo + (hi - lo) / 10 * b.bin, 6) AS lower,
       round(lo + (hi - lo) / 10 * (b.bin + 1), 6) AS upper, count(v) AS n
FROM (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
      FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {table})) s
CROSS JOIN (SELECT unnest(range(10)) AS bin) b
LEFT JOIN (SELECT CAST({column} AS DOUBLE) AS v FROM {table}) x
     ON least(floor((v - lo) / (hi - lo) * 10), 9) = b.bin
GROUP BY b.bin, lo, hi"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    # preparation
    q["merge_student"] = f"WITH {RAW} SELECT * FROM student_merged"
    q["merge_assessment"] = f"WITH {RAW} SELECT * FROM assessment_merged"
    q["merge_vle"] = f"WITH {RAW} SELECT * FROM vle_merged"
    q["clean_student"] = _prepared("SELECT * FROM student_clean")
    q["clean_assessment"] = _prepared("SELECT * FROM assessment_clean")
    q["impute_mode_imd_band"] = _prepared(
        f"SELECT {LC}, coalesce(imd_band, (SELECT mode_band FROM imd_mode)) AS imd_band FROM student_distinct")
    q["typecast_student"] = _prepared(f"SELECT {LC}, disability, withdrew FROM student_data")
    q["typecast_assessment"] = _prepared(
        f"SELECT {LC}, id_assessment, date_submitted, score, is_banked FROM assessment_data")
    q["registration_duration"] = _prepared(f"SELECT {LC}, registration_duration FROM student_data")
    q["average_score_window"] = _prepared(
        f"SELECT {LC}, id_assessment, date_submitted, score, round(average_score, 6) AS average_score FROM assessment_data")
    q["resource_text"] = _prepared("SELECT * FROM resource_data")
    q["interaction_data"] = _prepared("SELECT * FROM interaction_data")
    # splits and features
    q["history_at_cutoff"] = _prepared("SELECT * FROM vle_data WHERE date <= 86")
    q["drop_leaking_columns"] = _prepared(
        "SELECT * EXCLUDE (registration_duration, final_result, withdrew, date_unregistration) FROM student_data")
    q["leakage_safe_student"] = _prepared(
        "SELECT * EXCLUDE (registration_duration, final_result, withdrew, date_unregistration) FROM student_data WHERE date_registration <= 86")
    q["leakage_safe_assessment"] = _prepared(
        "SELECT * EXCLUDE (average_score) FROM assessment_data WHERE date_submitted <= 86")
    q["ml_temporal_split_counts"] = _prepared("""
SELECT 'training_history' AS part, count(*) AS n, CAST(sum(sum_click) AS BIGINT) AS clicks, min(date) AS min_day, max(date) AS max_day FROM vle_data WHERE date <= 86
UNION ALL SELECT 'training_future', count(*), CAST(sum(sum_click) AS BIGINT), min(date), max(date) FROM vle_data WHERE date > 86 AND date <= 150
UNION ALL SELECT 'test_history', count(*), CAST(sum(sum_click) AS BIGINT), min(date), max(date) FROM vle_data WHERE date <= 150
UNION ALL SELECT 'test_future', count(*), CAST(sum(sum_click) AS BIGINT), min(date), max(date) FROM vle_data WHERE date > 150""")
    for name, test in (("history", "<="), ("future", ">")):
        q[f"temporal_split_{name}"] = _prepared(f"""
SELECT {LC}, id_site, activity_type, CAST(sum(sum_click) AS BIGINT) AS total_resource_clicks, min(date) AS first_used,
       max(date) AS last_used, max(date) - min(date) AS click_duration
FROM vle_data WHERE date {test} 150 AND activity_type IS NOT NULL GROUP BY ALL""")
    q["cv_fold_split"] = _prepared("""
SELECT fold, CASE WHEN date <= cutoff_day THEN 'history' ELSE 'future' END AS part, count(*) AS n,
       CAST(sum(sum_click) AS BIGINT) AS clicks, min(date) AS min_day, max(date) AS max_day
FROM vle_data JOIN (VALUES (1, 60, 120), (2, 120, 180), (3, 180, 240)) f(fold, cutoff_day, test_end) ON date <= test_end
GROUP BY ALL""")
    f86 = features_sql("learner_features", 86)
    q["assessment_features"] = _prepared("").rstrip() + f86 + (
        f" SELECT {LC}, {_rounded_list(FEATURES.split(', total')[0])} FROM learner_features_assessment")
    q["vle_features"] = _prepared("").rstrip() + f86 + (
        f" SELECT {LC}, total_resource_clicks, round(average_resource_clicks, 6) AS average_resource_clicks, first_used, last_used, resources_used, interaction_duration FROM learner_features_vle")
    q["student_features"] = _prepared("").rstrip() + f86 + (
        f" SELECT {LC}, {PERSON}, {_rounded_list(FEATURES)} FROM learner_features")
    # scorers
    for name, table in (("popularity", "pop"), ("collaborative", "collab"), ("content", "content"), ("random", "random_list")):
        q[f"{name}_scores"] = _scored(f"SELECT id_student, {ITEM}, {_r(f'{name}_score')} FROM {table}")
    q["hybrid_scores"] = _scored(
        f"SELECT id_student, {ITEM}, {_r('popularity_score', 'content_score', 'collaborative_score', 'hybrid_score')} FROM hybrid")
    q["popularity_cold_start"] = _scored(
        f"SELECT {ITEM}, round(raw / max(raw) OVER (), 6) AS popularity_score FROM items")
    for name in ("popularity", "collaborative", "content", "hybrid", "random"):
        q[f"topk_{name}"] = _scored(
            f"SELECT {LC}, id_site, position, round(score, 6) AS {name}_score FROM best WHERE recommender = '{name}'")
    q["tfidf_weights"] = _scored(
        "SELECT DISTINCT course_set, resource_text, term, round(w, 6) AS weight FROM vectors JOIN catalogue USING (fold, course_set, id_site)")
    q["document_term_weights"] = r"""
WITH tf AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents)
  GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (
  SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w
  FROM tf JOIN df USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"""
    q["document_similarity"] = r"""
WITH tf AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents)
  GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (
  SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w
  FROM tf JOIN df USING (term)),
v AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w),
centre AS (SELECT lang, term, sum(w) AS c FROM v JOIN documents USING (doc_id) GROUP BY ALL)
SELECT lang, doc_id, round(sum(w * c) - 1.0, 6) AS total_similarity
FROM v JOIN documents USING (doc_id) JOIN centre USING (lang, term) GROUP BY ALL"""
    q["learner_similarity"] = _scored(
        "SELECT s.course_set, s.id_student, round(coalesce(sum(cosine), 0), 6) AS total_similarity FROM sets s LEFT JOIN learner_pairs p ON p.fold = s.fold AND p.learner = s.id_student GROUP BY ALL")
    q["resource_similarity"] = _scored(
        "SELECT course_set, site AS id_site, round(sum(cosine) - 1, 6) AS total_similarity FROM resource_pairs GROUP BY ALL")
    q["explanations"] = _scored(f"""
SELECT {LC}, id_site, position,
       CASE WHEN 0.4 * popularity_score >= 0.2 * content_score AND 0.4 * popularity_score >= 0.4 * collaborative_score
            THEN 'This resource was recommended because it is frequently used by other students'
            WHEN 0.2 * content_score >= 0.4 * collaborative_score
            THEN 'This resource was recommended because it is similar to other interacted-with resources'
            ELSE 'This resource was recommended because it is used by similar students' END AS explanation
FROM (
  SELECT *, row_number() OVER (PARTITION BY {LC} ORDER BY round(hybrid_score, 9) DESC, id_site) AS position
  FROM hybrid QUALIFY position <= 20)""")
    q["pair_similarity"] = _scored("""
, clicked AS (
  SELECT course_set, id_site AS site, sum(clicks) AS clicks FROM (
    SELECT s.course_set, h.id_site, h.clicks
    FROM hist h JOIN sets s USING (fold, id_student)
    SEMI JOIN catalogue c ON c.course_set = s.course_set AND c.id_site = h.id_site) GROUP BY ALL),
favourite AS (
  SELECT course_set, site FROM clicked QUALIFY row_number() OVER (PARTITION BY course_set ORDER BY clicks DESC, site) = 1)
SELECT f.course_set, f.site AS id_site, c.id_site AS other, round(coalesce(p.cosine, 0), 6) AS similarity
FROM favourite f JOIN catalogue c ON c.course_set = f.course_set
LEFT JOIN resource_pairs p ON p.course_set = f.course_set AND p.site = f.site AND p.other = c.id_site""")
    # evaluation
    q["evaluated_learner_courses"] = _scored(
        f"SELECT {LC} FROM lc SEMI JOIN fut USING (fold, {LC})")
    q["relevant_items"] = _scored(f"SELECT {LC}, id_site FROM relevant")
    q["hits_at_k"] = _scored(f"SELECT {LC}, recommender, hits FROM hits SEMI JOIN spine USING (fold, {LC})")
    q["metrics_at_k"] = _scored(
        f"SELECT {LC}, recommender, n_relevant, hits, {_r('precision', 'recall', 'f1')} FROM metrics WHERE recommender = 'popularity'")
    q["evaluate_baselines"] = _scored(
        f"SELECT {LC}, recommender, n_relevant, hits, {_r('precision', 'recall', 'f1')} FROM metrics")
    summary = "SELECT recommender, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM metrics GROUP BY ALL"
    q["evaluation_summary"] = _scored(f"SELECT recommender, {_r('precision', 'recall', 'f1')} FROM ({summary})")
    q["evaluate_single_learner"] = _scored(f"""
, learner_best AS (
  SELECT *, row_number() OVER (PARTITION BY recommender, id_student ORDER BY round(score, 9) DESC, id_site) AS place FROM lists
  QUALIFY place <= 20),
learner_relevant AS (
  SELECT DISTINCT id_student, id_site FROM fut ANTI JOIN used USING (id_student, id_site)),
learner_hits AS (
  SELECT id_student, recommender, count(DISTINCT id_site) AS hits FROM learner_best JOIN learner_relevant USING (id_student, id_site) GROUP BY ALL),
learner_spine AS (
  SELECT s.id_student, count(r.id_site) AS n_relevant FROM sets s LEFT JOIN learner_relevant r USING (id_student) GROUP BY ALL),
m AS (
  SELECT id_student, recommender, n_relevant, coalesce(hits, 0) AS hits, coalesce(hits, 0) / 20.0::DOUBLE AS precision,
         CASE WHEN n_relevant = 0 THEN 0 ELSE coalesce(hits, 0) / n_relevant::DOUBLE END AS recall
  FROM learner_spine CROSS JOIN recommenders LEFT JOIN learner_hits USING (id_student, recommender))
SELECT id_student, recommender, n_relevant, hits, {_r('precision', 'recall')},
       round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1 FROM m""")
    cv = "SELECT fold, recommender, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM metrics GROUP BY ALL"
    q["cv_baselines"] = _scored(
        f"SELECT fold, cutoff_day, test_end, recommender, {_r('precision', 'recall', 'f1')} FROM ({cv}) JOIN folds USING (fold)", FOLDS)
    q["cv_summary"] = _scored(
        "SELECT recommender, " + ", ".join(
            f"round(avg({m}), 6) AS {m}_mean, round(stddev_samp({m}), 6) AS {m}_std" for m in ("precision", "recall", "f1"))
        + f" FROM ({cv}) GROUP BY recommender", FOLDS)
    q["summary_upsert"] = _scored(f"""
SELECT recommender, {_r('precision', 'recall', 'f1')} FROM (
  SELECT recommender, CASE WHEN recommender = 'random' THEN 0 ELSE avg(precision) END AS precision,
         CASE WHEN recommender = 'random' THEN 0 ELSE avg(recall) END AS recall,
         CASE WHEN recommender = 'random' THEN 0 ELSE avg(f1) END AS f1 FROM metrics GROUP BY recommender)""")
    q["model_comparison"] = _scored(
        f"SELECT recommender, {_r('precision', 'recall', 'f1')} FROM ({summary}) WHERE recommender IN ('popularity', 'random')")
    # candidates and ranker input
    q["generate_candidates"] = _scored(
        f"SELECT {LC}, id_site, {_r('popularity_score', 'collaborative_score', 'content_score')}, activity_type, resource_text FROM candidates",
        extra=CANDIDATES)
    ml_columns = (
        f"{LC}, id_site, activity_type, resource_text, target, {PERSON}, "
        f"{_rounded_list(', '.join(NUMERIC[:3]) + ', ' + FEATURES)}")
    q["ml_dataset"] = _ml(f"SELECT {ml_columns} FROM ml_dataset")
    q["model_input"] = _ml(
        "SELECT target, resource_text, gender, region, highest_education, imd_band, age_band, CAST(disability AS VARCHAR) AS disability, "
        + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in NUMERIC) + " FROM ml_dataset")
    quotas = """
, n AS (SELECT target, count(*) AS class_rows FROM ml_dataset GROUP BY target),
e AS (SELECT target, 10000.0 * class_rows / sum(class_rows) OVER () AS exact FROM n),
f AS (SELECT target, floor(exact) AS base, row_number() OVER (ORDER BY exact - floor(exact) DESC, target) AS place,
             10000 - sum(floor(exact)) OVER () AS missing FROM e),
quotas AS (SELECT target, CAST(base + CASE WHEN place <= missing THEN 1 ELSE 0 END AS BIGINT) AS n FROM f)"""
    q["stratified_sample_counts"] = _ml(quotas + " SELECT target, n FROM quotas")
    q["stratified_sample"] = _ml(quotas + f"""
, drawn AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY
    substr(md5('10:' || id_student || ':' || code_module || ':' || code_presentation || ':' || id_site), 1, 8), {LC}, id_site) AS place
  FROM ml_dataset)
SELECT {ml_columns} FROM drawn JOIN quotas USING (target) WHERE place <= n""")
    q["numeric_scaling"] = _ml(f"""
, melted AS ({_melted('ml_dataset', NUMERIC, 'DOUBLE')}),
filled AS (SELECT "column", coalesce(value, median(value) OVER (PARTITION BY "column")) AS value,
                  median(value) OVER (PARTITION BY "column") AS m FROM melted)
SELECT "column", round(any_value(m), 6) AS median, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std
FROM filled GROUP BY "column\"""")
    q["category_modes"] = _ml(f"""
, melted AS ({_melted('ml_dataset', ['gender', 'region', 'highest_education', 'imd_band', 'age_band', 'disability'], 'VARCHAR')}),
n AS (SELECT "column", value, count(*) AS n FROM melted WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", value AS mode FROM n QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1""")
    stand_in = """
, scored AS (
  SELECT *, 0.4::DOUBLE * popularity_score + 0.2::DOUBLE * content_score + 0.4::DOUBLE * collaborative_score AS ML_score FROM labelled)"""
    q["classifier_metrics"] = _ml(stand_in + """
, s AS (
  SELECT target, round(ML_score, 9) AS sc, rank() OVER (ORDER BY round(ML_score, 9)) + (count(*) OVER (PARTITION BY round(ML_score, 9)) - 1) / 2.0 AS r FROM scored),
a AS (
  SELECT sum(target)::DOUBLE AS p, count(*)::DOUBLE AS n, sum(CASE WHEN sc > 0.5 THEN 1 ELSE 0 END)::DOUBLE AS said,
         sum(CASE WHEN sc > 0.5 AND target = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp, sum(CASE WHEN target = 1 THEN r ELSE 0 END)::DOUBLE AS rs FROM s)
SELECT 'hybrid' AS model, round(tp / said, 6) AS classifier_precision, round(tp / p, 6) AS classifier_recall,
       round(2 * tp / (said + p), 6) AS classifier_f1, round((rs - p * (p + 1) / 2) / (p * (n - p)), 6) AS classifier_roc_auc FROM a""")
    q["evaluate_scored_candidates"] = _ml(stand_in + f"""
, place AS (
  SELECT *, row_number() OVER (PARTITION BY {LC} ORDER BY round(ML_score, 9) DESC, id_site) AS place FROM scored QUALIFY place <= 20),
h AS (SELECT {LC}, CAST(sum(target) AS BIGINT) AS hits FROM place GROUP BY ALL),
m AS (SELECT {LC}, n_relevant, hits, hits / 20.0::DOUBLE AS precision, hits / n_relevant::DOUBLE AS recall FROM spine JOIN h USING ({LC}))
SELECT {LC}, 'hybrid' AS recommender, n_relevant, hits, {_r('precision', 'recall')},
       round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1 FROM m""")
    # profiles
    counted = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, \"column\", value, count(*) AS n FROM ({_melted(t, cols, 'VARCHAR')}) WHERE value IS NOT NULL GROUP BY ALL"
        for t, cols in (
            ("student_data", ["gender", "code_module", "region", "final_result", "disability"]),
            ("assessment_data", ["assessment_type", "is_banked"]),
            ("vle_data", ["activity_type"]),
            ("resource_data", ["code_module"]),
        ))
    q["value_counts"] = _prepared(
        f"SELECT table_name, \"column\", value, n, round(n / sum(n) OVER (PARTITION BY table_name, \"column\")::DOUBLE, 6) AS share FROM ({counted})")
    q["row_sample"] = _prepared("""
SELECT * FROM student_data
ORDER BY substr(md5('10:' || id_student || ':' || code_module || ':' || code_presentation), 1, 8), id_student, code_module, code_presentation
LIMIT 5""")
    q["crosstab_normalized"] = _prepared("""
SELECT m.code_module, a.activity_type,
       round(count(r.id_site) / (sum(count(r.id_site)) OVER (PARTITION BY m.code_module))::DOUBLE, 6) AS share
FROM (SELECT DISTINCT code_module FROM resource_data) m CROSS JOIN (SELECT DISTINCT activity_type FROM resource_data) a
LEFT JOIN resource_data r ON r.code_module = m.code_module AND r.activity_type = a.activity_type
GROUP BY m.code_module, a.activity_type""")
    q["assessments_per_learner"] = _prepared(
        "SELECT id_student, count(id_assessment) AS n_assessments FROM assessment_data GROUP BY id_student")
    q["clicks_per_learner"] = _prepared(
        "SELECT id_student, CAST(sum(total_resource_clicks) AS BIGINT) AS clicks FROM interaction_data GROUP BY id_student")
    q["histogram"] = _prepared(" UNION ALL ".join([
        _histogram("assessment_data", "average_score", "average_score"),
        _histogram("(SELECT count(id_assessment) AS n FROM assessment_data GROUP BY id_student)", "n", "assessments_per_learner"),
        _histogram("vle_data", "module_presentation_length", "module_presentation_length"),
        _histogram("(SELECT sum(total_resource_clicks) AS n FROM interaction_data GROUP BY id_student)", "n", "clicks_per_learner"),
    ]))
    q["avg_click_duration"] = _prepared(
        "SELECT activity_type, round(avg(click_duration), 6) AS average_click_duration FROM interaction_data GROUP BY ALL")
    q["boxplot_stats"] = _prepared("""
, s AS (SELECT quantile_cont(registration_duration, 0.25) AS q1, median(registration_duration) AS median,
              quantile_cont(registration_duration, 0.75) AS q3 FROM student_data),
x AS (SELECT registration_duration AS v, s.*, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM student_data CROSS JOIN s)
SELECT q1, median, q3, min(v) FILTER (inside) AS lower_whisker, max(v) FILTER (inside) AS upper_whisker,
       count(*) FILTER (NOT inside) AS outliers, count(*) AS n FROM x GROUP BY q1, median, q3""")
    q["duplicate_profile"] = f"WITH {RAW} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, n, n - d AS duplicates, round((n - d) / n::DOUBLE, 6) AS share FROM (SELECT count(*) AS n FROM {t}), (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM {t}))"
        for t in ("student_merged", "assessment_merged", "vle_merged", "vle"))
    columns = {
        "student_merged": ["id_student", "code_module", "code_presentation", "gender", "region", "highest_education", "imd_band",
                           "age_band", "num_of_prev_attempts", "studied_credits", "disability", "final_result", "date_registration",
                           "date_unregistration", "module_presentation_length"],
        "assessment_merged": ["code_module", "code_presentation", "id_assessment", "id_student", "date_submitted", "is_banked", "score",
                              "assessment_type", "date", "weight", "module_presentation_length"],
        "vle_merged": ["id_site", "code_module", "code_presentation", "id_student", "date", "sum_click", "activity_type", "week_from",
                       "week_to", "module_presentation_length"],
    }
    q["null_profile"] = f"WITH {RAW} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS n_null FROM {t}"
        for t, names in columns.items() for c in names)
    q["day_profile"] = _prepared(
        "SELECT min(date) AS min_day, median(date) AS median_day, max(date) AS max_day FROM vle_data")
    q["site_uniqueness"] = _prepared(
        "SELECT max(n) AS max_courses_per_site FROM (SELECT count(DISTINCT code_module || '|' || code_presentation) AS n FROM resource_data GROUP BY id_site)")
    q["top_interaction"] = _prepared(
        "SELECT * FROM interaction_data ORDER BY total_resource_clicks DESC, id_student, id_site LIMIT 1")
    q["learner_count"] = _prepared("SELECT count(DISTINCT id_student) AS n_learners FROM interaction_data")
    return q
