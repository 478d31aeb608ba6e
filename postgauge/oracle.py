"""Plain SQL for the registered queries, written for DuckDB over the same tables.

The statements take their own road where they can: tokens are unnested and counted
rather than matched in place, so agreement says something.
"""

from __future__ import annotations

from postgauge.functions import fixed

WS = fixed.WHITESPACE
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS}]"

TABLES = {
    "abbreviations": r"""
found AS (SELECT unnest(regexp_extract_all(text, '\p{L}+(?:\.\p{L}+)*\.?')) AS token FROM documents),
stops AS (SELECT lower(rtrim(token, '.')) AS word, count(*) AS n, count(*) FILTER (ends_with(token, '.')) AS n_stop FROM found GROUP BY 1),
rate AS (SELECT sum(n_stop) / sum(n) AS p FROM stops),
sized AS (
  SELECT *, length(replace(word, '.', '')) AS letters, n - n_stop AS rest,
    2 * (n_stop * ln(0.99) + (n - n_stop) * ln(0.01) - n_stop * ln(p) - (n - n_stop) * ln(1 - p)) AS ratio FROM stops, rate),
abbreviations AS (
  SELECT word, n, n_stop, score FROM (
    SELECT *, ratio * (length(word) - letters + 1) * exp(-letters) * pow(letters::DOUBLE, -rest::DOUBLE) AS score FROM sized WHERE n_stop > 0)
  WHERE score >= 0.3)""",
    "posts": """
c AS (
  SELECT conv_id*1000+turn AS Id, CASE WHEN role='user' THEN 1 ELSE 2 END AS PostTypeId,
         conv_id, turn, text AS Body
  FROM conversations WHERE role IN ('user','assistant')),
p AS (
  SELECT *, CASE WHEN PostTypeId=2 THEN
      max(CASE WHEN PostTypeId=1 THEN Id END) OVER (PARTITION BY conv_id ORDER BY turn
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS ParentId
  FROM c),
n AS (SELECT ParentId AS pid, count(*) AS cnt, min(Id) AS first_answer
      FROM p WHERE ParentId IS NOT NULL GROUP BY ParentId),
posts AS (
  SELECT p.Id, p.PostTypeId, p.ParentId,
       CASE WHEN p.PostTypeId=1 THEN substr(p.Body,1,60) END AS Title,
       p.Body,
       CAST((p.conv_id*7+p.turn*13)%17-3 AS INT) AS Score,
       CASE WHEN p.conv_id%11=0 THEN NULL ELSE CAST(p.conv_id%97 AS VARCHAR(20)) END AS OwnerUserId,
       CASE WHEN p.PostTypeId=1 AND p.conv_id%3=0 THEN n.first_answer END AS AcceptedAnswerId,
       CASE WHEN p.PostTypeId=1 AND p.conv_id%13=0 THEN '2024-01-01' END AS ClosedDate,
       CASE WHEN p.PostTypeId=1 THEN coalesce(n.cnt,0) END AS AnswerCount
  FROM p LEFT JOIN n ON p.Id=n.pid)""",
    "doc_posts": """
doc_posts AS (SELECT doc_id AS Id, split_part(text, chr(10), 1) AS Title, text AS Body FROM documents)""",
    "lexicon": """
lexicon AS (
  SELECT word, greatest(1, len(regexp_extract_all(word, '[aeiouy]+'))) AS syl,
         row_number() OVER (ORDER BY word) - 1 AS rn
  FROM (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS word FROM benchmark))""",
    "word_vectors": """
word_vectors AS (
  SELECT word, CAST(embedding AS DOUBLE[]) AS vector FROM lexicon JOIN embeddings ON rn = vec_id)""",
    "doc_tokens": f"""
doc_tokens AS (SELECT doc_id, unnest(regexp_extract_all(text, '{TOKEN}')) AS token FROM documents)""",
    "labeled": """
labeled AS (
  SELECT *, CASE WHEN ClosedDate IS NOT NULL THEN 0 WHEN Score < 0 THEN 0
      WHEN AcceptedAnswerId IS NOT NULL AND trim(CAST(AcceptedAnswerId AS VARCHAR)) <> '' AND Score >= 5 THEN 1
      WHEN Score >= 10 THEN 1 WHEN Score = 0 THEN 0 ELSE -1 END AS label
  FROM posts)""",
    "split": """
short AS (
  SELECT Id, CAST(Score AS DOUBLE) AS Score, length(Body) AS BodyLength FROM posts
  WHERE PostTypeId = 1 AND length(Body) < 2000),
split AS (
  SELECT *, CASE WHEN Score <= (SELECT quantile_cont(Score, 0.5) FROM short) THEN 'low' ELSE 'high' END AS score_group
  FROM short)""",
    "cleaned": """
q AS (
  SELECT score_group, quantile_cont(Score, 0.25) AS s1, quantile_cont(Score, 0.75) AS s3,
         quantile_cont(BodyLength, 0.25) AS b1, quantile_cont(BodyLength, 0.75) AS b3
  FROM split GROUP BY score_group),
cleaned AS (
  SELECT Id, score_group,
    CASE WHEN Score BETWEEN s1 - 1.5*(s3-s1) AND s3 + 1.5*(s3-s1) THEN Score END AS Score,
    CASE WHEN BodyLength BETWEEN b1 - 1.5*(b3-b1) AND b3 + 1.5*(b3-b1) THEN CAST(BodyLength AS DOUBLE) END AS BodyLength
  FROM split JOIN q USING (score_group))""",
    "judged": """
judged AS (
  SELECT l.quality AS y, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS p
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)""",
    "keyed": """
keyed AS (SELECT *, coalesce(OwnerUserId, 'unknown_' || CAST(Id AS VARCHAR)) AS g FROM posts)""",
    "edits": """
edits AS (
  SELECT user_id AS Id, event_id, ts, event_type AS key,
         CAST(CAST(floor(value*100) AS BIGINT) AS VARCHAR(20)) AS value FROM events)""",
    "applied": """
users AS (SELECT DISTINCT Id FROM edits),
old AS (
  SELECT Id, 'click' AS key, 'old' AS value FROM users WHERE Id % 5 <> 0
  UNION ALL SELECT Id, 'u' || CAST(Id % 3 AS VARCHAR), 'kept' FROM users WHERE Id % 5 <> 0),
fresh AS (
  SELECT Id, key, value FROM edits WHERE value <> ''
  QUALIFY row_number() OVER (PARTITION BY Id, key ORDER BY ts DESC, event_id DESC) = 1),
applied AS (
  SELECT * FROM fresh
  UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.Id = old.Id AND f.key = old.key))""",
}


def sql(tables: str, select: str) -> str:
    parts = [TABLES[t].strip() for t in tables.split()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select.strip()


def _flesch(sentences: str, words: str, syllables: str) -> str:
    return (
        f"CASE WHEN {sentences} = 0 OR {words} = 0 THEN 0.0::DOUBLE ELSE CAST(206.835 AS DOUBLE)"
        f" - CAST(1.015 AS DOUBLE) * ({words}::DOUBLE / {sentences}) - CAST(84.6 AS DOUBLE) * ({syllables}::DOUBLE / {words}) END"
    )


SYLLABLES = r"CASE WHEN syl IS NOT NULL THEN syl WHEN regexp_full_match(token, '\p{L}+') THEN 1 ELSE 0 END"
ALPHABETIC = r"CASE WHEN regexp_full_match(token, '\p{L}+') THEN 1 ELSE 0 END"


def _readability(source: str, row_id: str, text: str) -> str:
    """Common tables `base`, `tok`, `scored` for white-space readability."""
    return rf"""
base AS (SELECT {row_id} AS rid, {text} AS t FROM {source}),
sent AS (
  SELECT rid, count(*) AS n FROM (SELECT rid, unnest(regexp_split_to_array(t, '[.!?]+')) AS s FROM base)
  WHERE regexp_matches(s, '[^{WS}]') GROUP BY rid),
tok AS (SELECT rid, unnest(regexp_extract_all(t, '[^.!?{WS}]+')) AS token FROM base),
wrd AS (
  SELECT rid, sum({ALPHABETIC}) AS w, sum({SYLLABLES}) AS y
  FROM tok LEFT JOIN lexicon ON lower(token) = word GROUP BY rid),
scored AS (
  SELECT rid, {_flesch("coalesce(n,0)", "coalesce(w,0)", "coalesce(y,0)")} AS flesch_score
  FROM base LEFT JOIN sent USING (rid) LEFT JOIN wrd USING (rid))"""


def _report(text: str) -> str:
    """Common tables `base`, `tok`, `report` for the token-based statistics."""
    words = lambda ws: ", ".join(f"'{w}'" for w in ws)
    return rf"""
base AS (SELECT doc_id, {text} AS t FROM documents),
sent AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT doc_id, unnest(string_split(regexp_replace(t, '([.!?])[{WS}]+', '\1' || chr(1), 'g'), chr(1))) AS s FROM base)
  WHERE regexp_matches(s, '[^{WS}]') GROUP BY doc_id),
tok AS (SELECT doc_id, unnest(regexp_extract_all(t, '{TOKEN}')) AS token FROM base),
agg AS (
  SELECT doc_id, count(*) AS tokens, count(DISTINCT token) AS uniq, sum(length(token)) AS chars,
         sum(CASE WHEN token IN ({words(fixed.REPORTING_VERBS)}) THEN 1 ELSE 0 END) AS told_said,
         sum(CASE WHEN token IN ({words(fixed.CONJUNCTIONS)}) THEN 1 ELSE 0 END) AS but_and,
         sum(CASE WHEN token IN ({words(fixed.WH_ADVERBS)}) THEN 1 ELSE 0 END) AS wh_adverbs,
         sum({ALPHABETIC}) AS words, sum({SYLLABLES}) AS syllables
  FROM tok LEFT JOIN lexicon ON lower(token) = word GROUP BY doc_id),
report AS (
  SELECT base.doc_id, CAST(coalesce(told_said,0) AS BIGINT) AS told_said, CAST(coalesce(but_and,0) AS BIGINT) AS but_and,
    CAST(coalesce(wh_adverbs,0) AS BIGINT) AS wh_adverbs,
    round(coalesce(chars::DOUBLE / tokens, 0), 6) AS mean_token_length,
    round(coalesce(uniq::DOUBLE / tokens, 0), 6) AS unique_fraction,
    CAST(coalesce(syllables,0) AS BIGINT) AS syllables, CAST(coalesce(words,0) AS BIGINT) AS words,
    CAST(coalesce(n,0) AS BIGINT) AS sentences,
    round({_flesch("coalesce(n,0)", "coalesce(words,0)", "coalesce(syllables,0)")}, 6) AS flesch_score
  FROM base LEFT JOIN sent USING (doc_id) LEFT JOIN agg USING (doc_id))"""


ASCII_TEXT = rf"regexp_replace(strip_accents(lower(regexp_replace(text, '^[{WS}]+|[{WS}]+\z', '', 'g'))), '[^\x00-\x7f]', '', 'g')"

# Every word run is fenced, so whole-word phrases need no look-around.
FENCED = r"regexp_replace({0}, '([\p{{L}}\p{{N}}_]+)', chr(1) || '\1' || chr(2), 'g')"
FENCED_PHRASES = "(?i)" + "|".join(
    " ".join(f"\\x01{w}\\x02" for w in phrase.split(" ")) for phrase in fixed.ACTION_PHRASES
)
ACTION_DENSITY_RAW = (
    f"coalesce(len(regexp_extract_all({FENCED.format('Body')}, '{FENCED_PHRASES}'))::DOUBLE"
    f" / nullif(len(regexp_extract_all(Body, '[^{WS}]+')), 0), 0)"
)
ACTION_DENSITY = f"round({ACTION_DENSITY_RAW}, 6)"
CAPS_RATIO_RAW = "coalesce(len(regexp_extract_all(coalesce(Title,''), '[A-Z]'))::DOUBLE / nullif(length(coalesce(Title,'')), 0), 0)"
CAPS_RATIO = f"round({CAPS_RATIO_RAW}, 6)"


def _strip_html() -> str:
    from postgauge.functions.text import COMMON_ENTITIES, HTML_DROPS

    out = "html"
    for pattern in HTML_DROPS:
        plain = pattern.replace("*+", "*").replace("'", "''")  # RE2 has no possessive form and needs none
        out = "regexp_replace({}, '{}', chr(65535), 'g')".format(out, plain)
    # These names are read without their semicolon too.
    for entity, char in COMMON_ENTITIES:
        out = "regexp_replace({}, '{}?', '{}', 'g')".format(out, entity, char.replace("'", "''"))
    return f"SELECT page_id, replace({out}, chr(65535), '') AS text FROM pages"


def _one_hot() -> str:
    branches = []
    for c in ("p_brand", "p_type", "p_name"):
        branches.append(
            f"""
  SELECT p_partkey, '{c}_' || k.{c} AS slot, CASE WHEN p.{c} = k.{c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
  FROM part p CROSS JOIN (SELECT {c} FROM rank_{c} WHERE n <= 5 OR r <= 4) k
  UNION ALL
  SELECT p_partkey, '{c}_{fixed.INFREQUENT_SUFFIX}', CASE WHEN r > 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  FROM part p JOIN rank_{c} USING ({c}) WHERE n > 5"""
        )
    ranks = ",\n".join(
        f"rank_{c} AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c} DESC) AS r, count(*) OVER () AS n FROM part GROUP BY {c})"
        for c in ("p_brand", "p_type", "p_name")
    )
    return "WITH " + ranks + "\n" + "\nUNION ALL".join(branches)


SPLIT_HASH = f"md5('{fixed.SEED}:' || g)"
DOC_AS_TEXT = "coalesce(Title,'') || ' ' || coalesce(Body,'')"

def _side(name: str) -> str:
    """Whether the author of row `Id` is on that side of the split."""
    return f"Id IN (SELECT Id FROM keyed WHERE ({SPLIT_HASH} < 'b3333333') = ({name!r} = 'train'))"


def _full_width(fitted: str = "true", shown: str = "true") -> str:
    """The feature matrix of the rows `shown`, scaled by the statistics of the rows `fitted`."""
    return sql("posts keyed lexicon word_vectors", "," + _readability("posts", "Id", DOC_AS_TEXT) + rf""",
words AS (SELECT Id, unnest(regexp_extract_all(coalesce(Body,'') || ' ' || coalesce(Title,''), '{TOKEN}')) AS token FROM posts),
uses AS (SELECT Id, token, count(*) AS n FROM words GROUP BY Id, token),
cells AS (SELECT Id, n, unnest(range(64)) AS dim, unnest(vector) AS v FROM uses JOIN word_vectors ON token = word),
means AS (SELECT Id, dim, sum(v * n) / sum(n) AS value FROM cells GROUP BY Id, dim),
f AS (
  SELECT Id, unnest([length(coalesce(Title,''))::DOUBLE, length(Body)::DOUBLE, contains(coalesce(Title,''), '?')::INT::DOUBLE,
      contains(Body, '?')::INT::DOUBLE, flesch_score, {ACTION_DENSITY_RAW}, {CAPS_RATIO_RAW}]) AS value,
    64 + unnest(range(7)) AS dim
  FROM posts JOIN scored ON Id = rid),
m AS (SELECT dim, avg(value) AS mean, stddev_pop(value) AS dev FROM f WHERE {fitted} GROUP BY dim)
SELECT Id, dim, round(coalesce(value, 0), 6) AS value
FROM (SELECT Id, unnest(range(64)) AS dim FROM posts) LEFT JOIN means USING (Id, dim) WHERE {shown}
UNION ALL
SELECT Id, dim, round((value - mean) / CASE WHEN dev = 0 THEN 1 ELSE dev END, 6) FROM f JOIN m USING (dim) WHERE {shown}""")


def _predicted() -> str:
    """Test rows that have a label, each with an answer of 0 or 1."""
    return sql("posts labeled keyed", f"""
SELECT Id, label::BIGINT AS label, 1::BIGINT AS answered FROM labeled WHERE label <> -1 AND {_side("test")}""")


ORACLES: dict[str, str] = {
    "read_posts_limited": sql("posts", f"SELECT Id, PostTypeId::BIGINT AS PostTypeId, Score::BIGINT AS Score FROM posts ORDER BY Id LIMIT {fixed.ROW_CAP}"),
    "normalize_group_key": sql("posts", """
SELECT Id, CASE WHEN raw NOT IN ('None','nan') THEN raw END AS OwnerUserId FROM (
  SELECT Id, CASE WHEN OwnerUserId IS NULL THEN 'None' WHEN Id % 7 = 0 THEN 'nan' ELSE OwnerUserId END AS raw FROM posts)"""),
    "strip_html": _strip_html(),
    "filter_questions": sql("posts", "SELECT Id, Title, Score::BIGINT AS Score FROM posts WHERE PostTypeId = 1"),
    "clean_tags": r"""
SELECT p_partkey, regexp_replace(regexp_replace('<' || p_type || '><' || p_brand || '>|[' || p_name || ']' || chr(9),
  '[\[\]<>|]', ' ', 'g'), '^\s+|\s+$', '', 'g') AS Tags FROM part""",
    "coerce_numeric": sql("posts", """
SELECT Id, TRY_CAST(CASE WHEN Id % 7 = 0 THEN 'n/a' WHEN Id % 11 = 0 THEN '' ELSE CAST(Score AS VARCHAR) END AS DOUBLE) AS Score FROM posts"""),
    "quality_label": sql("posts labeled", "SELECT Id, label::BIGINT AS label FROM labeled"),
    "labeled_training_set": sql("posts labeled", """
SELECT Id, PostTypeId::BIGINT AS PostTypeId, ParentId, Title, Body, OwnerUserId, AcceptedAnswerId, ClosedDate, AnswerCount, label::BIGINT AS label
FROM labeled WHERE label <> -1"""),
    "median_label": sql("posts", """
SELECT Id, CASE WHEN Score > (SELECT quantile_cont(Score, 0.5) FROM posts) THEN 1 ELSE 0 END::BIGINT AS label FROM posts"""),
    "answered_flag": sql("posts", "SELECT Id, CASE WHEN AnswerCount > 0 THEN 'Answered' ELSE 'Unanswered' END AS cluster FROM posts"),
    "fill_display_text": sql("posts", """
SELECT Id, coalesce(Title, 'No Title') AS Title, coalesce(OwnerUserId, 'No OwnerUserId') AS OwnerUserId,
  coalesce(CAST(Score AS VARCHAR), 'No Score') AS Score, coalesce(CAST(AnswerCount AS VARCHAR), 'No AnswerCount') AS AnswerCount FROM posts"""),
    "concat_text": sql("posts", "SELECT Id, coalesce(Title,'') || ' ' || coalesce(Body,'') AS text FROM posts"),
    "select_features": sql("posts", "SELECT Title, Body FROM posts"),
    "match_questions_answers": sql("posts", """
SELECT q.Id AS QuestionId, q.Body AS QuestionBody, a.Id AS AnswerId, a.Body AS AnswerBody
FROM posts q JOIN posts a ON a.ParentId = q.Id WHERE q.PostTypeId = 1 AND a.PostTypeId = 2"""),
    "unanswered_questions": sql("posts", """
SELECT Id, Score::BIGINT AS Score FROM posts q WHERE PostTypeId = 1
  AND NOT EXISTS (SELECT 1 FROM posts a WHERE a.PostTypeId = 2 AND a.ParentId = q.Id)"""),
    "answered_questions": sql("posts", """
SELECT Id, Score::BIGINT AS Score FROM posts q WHERE PostTypeId = 1
  AND EXISTS (SELECT 1 FROM posts a WHERE a.PostTypeId = 2 AND a.ParentId = q.Id)"""),
    "lexicon_lookup": sql("lexicon doc_tokens", f"""
SELECT token, CAST(max({SYLLABLES}) AS BIGINT) AS syllables, count(*) AS uses
FROM doc_tokens LEFT JOIN lexicon ON lower(token) = word GROUP BY token"""),
    "word_vector_lookup": sql("lexicon word_vectors doc_tokens", """
SELECT word, count(*) AS uses, round(max(list_sum(vector)), 6) AS vector_sum FROM doc_tokens JOIN word_vectors ON token = word GROUP BY word"""),
    "qa_counts": sql("posts", """
SELECT count(*) FILTER (WHERE pid IS NULL) AS unanswered, count(*) FILTER (WHERE AcceptedAnswerId IS NOT NULL) AS accepted,
  count(*) FILTER (WHERE pid IS NOT NULL) AS answered
FROM posts q LEFT JOIN (SELECT DISTINCT ParentId AS pid FROM posts WHERE PostTypeId = 2 AND ParentId IS NOT NULL) ON q.Id = pid
WHERE PostTypeId = 1"""),
    "label_distribution": sql("posts labeled", """
SELECT label::BIGINT AS label, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM labeled), 6) AS share FROM labeled GROUP BY label"""),
    "label_summary": sql("posts labeled", """
SELECT count(*) AS total, count(*) FILTER (WHERE label = -1) AS excluded, count(*) FILTER (WHERE label <> -1) AS kept FROM labeled"""),
    "score_median": sql("posts", "SELECT CAST(quantile_cont(Score, 0.5) AS DOUBLE) AS median FROM posts"),
    "score_split": sql("posts split", "SELECT Id, Score, BodyLength, score_group FROM split"),
    "iqr_filter": sql("posts split cleaned", "SELECT Id, score_group, Score, BodyLength FROM cleaned"),
    "length_histogram": sql("posts split cleaned", """
, ends AS (
  SELECT score_group, least(min(Score), min(BodyLength)) AS low, greatest(max(Score), max(BodyLength)) AS high
  FROM cleaned GROUP BY score_group),
cells AS (
  SELECT score_group, 'Score' AS series, Score AS x FROM cleaned WHERE Score IS NOT NULL
  UNION ALL SELECT score_group, 'BodyLength', BodyLength FROM cleaned WHERE BodyLength IS NOT NULL),
sizes AS (SELECT score_group, series, count(*) AS n FROM cells GROUP BY ALL),
binned AS (
  SELECT score_group, series, CAST(least(floor((x - low) * 60 / (high - low)), 59) AS BIGINT) AS bin, count(*) AS rows
  FROM cells JOIN ends USING (score_group) GROUP BY ALL)
SELECT s.score_group, s.series, b.bin, round(low + b.bin * ((high - low) / 60), 6) AS bin_start, coalesce(rows, 0) AS rows,
  round(coalesce(rows, 0) / (n * ((high - low) / 60)), 6) AS density
FROM sizes s JOIN ends e ON s.score_group = e.score_group CROSS JOIN (SELECT unnest(range(60)) AS bin) b
LEFT JOIN binned x ON x.score_group = s.score_group AND x.series = s.series AND x.bin = b.bin""").replace("\n, ends", ",\nends"),
    "distinct_values": "SELECT DISTINCT source FROM documents ORDER BY source",
    "confusion_matrix": sql("judged", """
SELECT a::BIGINT AS label, b::BIGINT AS prediction, count(y) AS n
FROM (SELECT unnest([0, 1]) AS a) CROSS JOIN (SELECT unnest([0, 1]) AS b) LEFT JOIN judged ON y = a AND p = b GROUP BY a, b"""),
    "binary_metrics": sql("judged", """
, m AS (
  SELECT avg(CASE WHEN y = p THEN 1.0::DOUBLE ELSE 0 END) AS accuracy,
    coalesce(count(*) FILTER (WHERE y = 1 AND p = 1)::DOUBLE / nullif(count(*) FILTER (WHERE p = 1), 0), 0) AS pr,
    coalesce(count(*) FILTER (WHERE y = 1 AND p = 1)::DOUBLE / nullif(count(*) FILTER (WHERE y = 1), 0), 0) AS re FROM judged)
SELECT round(accuracy, 6) AS accuracy, round(pr, 6) AS "precision", round(re, 6) AS recall,
  round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1_score FROM m""").replace("\n, m", ",\nm"),
    "classification_report": sql("judged", """
, k AS (
  SELECT c, coalesce(count(*) FILTER (WHERE y = c AND p = c)::DOUBLE / nullif(count(*) FILTER (WHERE p = c), 0), 0) AS pr,
    coalesce(count(*) FILTER (WHERE y = c AND p = c)::DOUBLE / nullif(count(*) FILTER (WHERE y = c), 0), 0) AS re,
    count(*) FILTER (WHERE y = c) AS support
  FROM judged CROSS JOIN (SELECT unnest([0, 1]) AS c) GROUP BY c),
f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM k),
a AS (SELECT avg(CASE WHEN y = p THEN 1.0::DOUBLE ELSE 0 END) AS v, count(*) AS n FROM judged),
r AS (
  SELECT CASE c WHEN 0 THEN 'Low Quality' ELSE 'High Quality' END AS name, pr, re, f1, support FROM f
  UNION ALL SELECT 'accuracy', v, v, v, n FROM a
  UNION ALL SELECT 'macro avg', avg(pr), avg(re), avg(f1), CAST(sum(support) AS BIGINT) FROM f
  UNION ALL SELECT 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support),
    sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f)
SELECT name, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f1, 6) AS f1_score, support FROM r""").replace("\n, k", ",\nk"),
    "mean_word_vector": sql("lexicon word_vectors doc_tokens", """
, uses AS (SELECT doc_id, token, count(*) AS n FROM doc_tokens GROUP BY doc_id, token),
dims AS (SELECT unnest(range(64)) AS dim),
cells AS (
  SELECT doc_id, n, unnest(range(64)) AS dim, unnest(vector) AS v FROM uses JOIN word_vectors ON token = word),
means AS (SELECT doc_id, dim, sum(v * n) / sum(n) AS value FROM cells GROUP BY doc_id, dim)
SELECT d.doc_id, dim AS dim, round(coalesce(value, 0), 6) AS value
FROM documents d CROSS JOIN dims LEFT JOIN means USING (doc_id, dim)""").replace("\n, uses", ",\nuses"),
    "qf_lengths": sql("doc_posts", "SELECT Id, length(Title) AS title_len, length(Body) AS body_len FROM doc_posts"),
    "qf_question_marks": sql("doc_posts", """
SELECT Id, CASE WHEN contains(Title, '?') THEN 1 ELSE 0 END::BIGINT AS title_ends_with_qmark,
  CASE WHEN contains(Body, '?') THEN 1 ELSE 0 END::BIGINT AS body_ends_with_qmark FROM doc_posts"""),
    "qf_caps_ratio": sql("doc_posts", f"SELECT Id, {CAPS_RATIO} AS title_caps_ratio FROM doc_posts"),
    "qf_flesch": sql("doc_posts lexicon", "," + _readability("doc_posts", "Id", DOC_AS_TEXT) + "\nSELECT rid AS Id, round(flesch_score, 6) AS flesch_score FROM scored"),
    "qf_action_density": sql("doc_posts", f"SELECT Id, {ACTION_DENSITY} AS action_verbs_density FROM doc_posts"),
    "quality_features": sql("posts lexicon", "," + _readability("posts", "Id", DOC_AS_TEXT) + f"""
SELECT Id, length(coalesce(Title,'')) AS title_len, length(Body) AS body_len,
  CASE WHEN contains(coalesce(Title,''), '?') THEN 1 ELSE 0 END::BIGINT AS title_ends_with_qmark,
  CASE WHEN contains(Body, '?') THEN 1 ELSE 0 END::BIGINT AS body_ends_with_qmark,
  round(flesch_score, 6) AS flesch_score, {ACTION_DENSITY} AS action_verbs_density, {CAPS_RATIO} AS title_caps_ratio
FROM posts JOIN scored ON Id = rid"""),
    "clean_text_ascii": f"SELECT doc_id, {ASCII_TEXT} AS text FROM documents",
    "tokenize_sentences": rf"""
WITH s AS (
  SELECT doc_id, unnest(list_filter(string_split(regexp_replace(text, '([.!?])[{WS}]+', '\1' || chr(1), 'g'), chr(1)),
    lambda x: regexp_matches(x, '[^{WS}]'))) AS sentence, generate_subscripts(list_filter(string_split(regexp_replace(text, '([.!?])[{WS}]+', '\1' || chr(1), 'g'), chr(1)),
    lambda x: regexp_matches(x, '[^{WS}]')), 1) - 1 AS sentence_no
  FROM documents)
SELECT doc_id, sentence_no, array_to_string(regexp_extract_all(sentence, '{TOKEN}'), ' ') AS tokens FROM s""",
    "learned_abbreviations": sql("abbreviations", "SELECT word, n, n_stop, round(score, 4) AS score FROM abbreviations"),
    "sentences_with_abbreviations": sql("abbreviations", rf"""
, s AS (
  SELECT doc_id, unnest(list_filter(string_split(regexp_replace(text, '([.!?])[{WS}]+', '\1' || chr(1), 'g'), chr(1)),
    lambda x: regexp_matches(x, '[^{WS}]'))) AS piece, generate_subscripts(list_filter(string_split(regexp_replace(text, '([.!?])[{WS}]+',
    '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '[^{WS}]')), 1) AS i
  FROM documents),
placed AS (
  SELECT doc_id, i, piece, lower(regexp_extract(piece, '(\p{{L}}+(\.\p{{L}}+)*)\.$', 1)) IN (SELECT word FROM abbreviations) AS goes_on FROM s),
numbered AS (
  SELECT *, coalesce(sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM placed),
joined AS (SELECT doc_id, sentence, sum(length(piece) + 1) - 1 AS size FROM numbered GROUP BY 1, 2)
SELECT doc_id, count(*) AS sentences, max(size)::BIGINT AS longest FROM joined GROUP BY 1""").replace("\n, s AS", ",\ns AS"),
    "word_usage": sql("doc_tokens", """
SELECT d.doc_id, count(token) AS uses FROM documents d
LEFT JOIN doc_tokens t ON t.doc_id = d.doc_id AND token IN ('but','and','the','que','der') GROUP BY d.doc_id"""),
    "unique_word_fraction": sql("lexicon", "," + _report("text") + "\nSELECT doc_id, unique_fraction FROM report"),
    "syllable_count": sql("lexicon", "," + _report("text") + "\nSELECT doc_id, syllables FROM report"),
    "word_count": sql("lexicon", "," + _report("text") + "\nSELECT doc_id, words FROM report"),
    "flesch_score": sql("lexicon", "," + _report("text") + "\nSELECT doc_id, sentences, words, syllables, flesch_score FROM report"),
    "text_report": sql("lexicon", "," + _report(ASCII_TEXT) + "\nSELECT * FROM report"),
    "impute_median": """
SELECT o_orderkey, round(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice ELSE
  (SELECT quantile_cont(o_totalprice, 0.5) FROM orders WHERE o_orderpriority <> '5-LOW') END, 6) AS price FROM orders""",
    "standard_scale": """
SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders), 6) AS price FROM orders""",
    "impute_constant": sql("posts", "SELECT Id, coalesce(OwnerUserId, 'missing') AS OwnerUserId FROM posts"),
    "one_hot_topk": _one_hot(),
    "date_parts": """
SELECT o_orderkey, year(o_orderdate) AS o_orderdate_year, month(o_orderdate) AS o_orderdate_month, day(o_orderdate) AS o_orderdate_day,
  year(o_orderdate) AS text_date_year, month(o_orderdate) AS text_date_month, day(o_orderdate) AS text_date_day FROM orders""",
    "fill_missing_groups": sql("posts keyed", "SELECT Id, g AS OwnerUserId FROM keyed"),
    "split_by_group": sql("posts keyed", f"""
SELECT Id, g AS OwnerUserId, CASE WHEN {SPLIT_HASH} < 'b3333333' THEN 'train' ELSE 'test' END AS side FROM keyed"""),
    "split_by_group_without_ids": sql("posts", f"""
, lost AS (SELECT CASE WHEN Id % 3 <> 0 THEN Id END AS Id, OwnerUserId, Body FROM posts),
named AS (
  SELECT Id, coalesce(OwnerUserId, 'unknown_' || coalesce(CAST(Id AS VARCHAR), md5(coalesce(Body, chr(30)) || chr(31)
      || coalesce(CAST(Id AS VARCHAR), chr(30)) || chr(31) || coalesce(OwnerUserId, chr(30))))) AS g FROM lost)
SELECT Id, g AS OwnerUserId, CASE WHEN {SPLIT_HASH} < 'b3333333' THEN 'train' ELSE 'test' END AS side FROM named""").replace("\n, lost", ",\nlost"),
    "split_by_group_exact": sql("posts keyed", f"""
, ranked AS (
  SELECT g, row_number() OVER (ORDER BY {SPLIT_HASH}) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT g FROM keyed))
SELECT Id, g AS OwnerUserId, CASE WHEN r <= floor(0.7 * n) THEN 'train' ELSE 'test' END AS side
FROM keyed JOIN ranked USING (g)""").replace("\n, ranked", ",\nranked"),
    "group_overlap": sql("posts keyed", f"""
SELECT g AS OwnerUserId FROM keyed WHERE {SPLIT_HASH} < 'b3333333'
INTERSECT SELECT g FROM keyed WHERE {SPLIT_HASH} >= 'b3333333'"""),
    "sample_questions": sql("posts", f"""
SELECT Id, Score::BIGINT AS Score FROM posts WHERE PostTypeId = 1 ORDER BY md5('{fixed.SEED}:' || CAST(Id AS VARCHAR)), Id LIMIT {fixed.SAMPLE_SIZE}"""),
    "class_weights": sql("posts labeled", """
SELECT label::BIGINT AS label, round((SELECT count(*) FROM labeled WHERE label <> -1)::DOUBLE
  / ((SELECT count(DISTINCT label) FROM labeled WHERE label <> -1) * count(*)), 6) AS weight FROM labeled WHERE label <> -1 GROUP BY label"""),
    "init_label_store": """
SELECT event_id, CASE WHEN starts_with(s, '{') THEN s ELSE '{}' END AS label_store FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'not json' WHEN event_type <> 'click' THEN props END AS s FROM events)""",
    "canonical_label_key": sql("edits applied", """
, messy AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '  ' || upper(key) || ' ' WHEN event_id % 3 = 1 THEN key
    WHEN key = 'view' THEN 'question_QUALITY' ELSE ' ' END AS key FROM edits),
registry AS (
  SELECT lower(key) AS folded, min(key) AS key FROM (
    SELECT key FROM old UNION ALL SELECT 'Question_quality' UNION ALL SELECT 'Answer_quality') GROUP BY 1)
SELECT event_id, coalesce(r.key, upper(left(trim(m.key), 1)) || lower(substr(trim(m.key), 2))) AS key
FROM messy m LEFT JOIN registry r ON lower(trim(m.key)) = folded WHERE trim(m.key) <> ''""").replace("\n, messy", ",\nmessy"),
    "apply_labels": sql("edits applied", "SELECT Id, key, value FROM applied"),
    "merged_label_table": sql("edits applied", "SELECT Id, key, value FROM applied"),
    "label_keys": sql("edits applied", """
SELECT DISTINCT key FROM (SELECT key FROM applied UNION ALL SELECT 'Question_quality' UNION ALL SELECT 'Answer_quality')"""),
    "expand_labels": sql("edits applied", "SELECT Id, " + ", ".join(
        f"max(CASE WHEN key = '{k}' THEN value END) AS {k}" for k in ("click", "error", "purchase", "signup", "u0", "u1", "u2", "view")
    ) + " FROM applied GROUP BY Id"),
    "single_label": sql("edits", """
SELECT u.Id, coalesce(v.value, 'Unlabeled') AS new_label FROM (SELECT DISTINCT Id FROM edits) u LEFT JOIN (
  SELECT Id, value FROM edits WHERE key = 'purchase' QUALIFY row_number() OVER (PARTITION BY Id ORDER BY ts DESC, event_id DESC) = 1) v ON u.Id = v.Id"""),
    "read_posts_xml": sql("posts", """
SELECT Id, PostTypeId::BIGINT AS PostTypeId, ParentId, Title, Body, Score::BIGINT AS Score, OwnerUserId, AcceptedAnswerId, ClosedDate, AnswerCount
FROM posts"""),
    "read_posts_csv": sql("posts", """
SELECT Id, PostTypeId::BIGINT AS PostTypeId, ParentId, nullif(Title, '') AS Title, nullif(Body, '') AS Body, Score::BIGINT AS Score,
  OwnerUserId, AcceptedAnswerId, ClosedDate, AnswerCount FROM posts WHERE PostTypeId = 1"""),
    "write_posts_csv": sql("posts keyed", f"""
SELECT Id, PostTypeId::BIGINT AS PostTypeId, ParentId, nullif(Title, '') AS Title, nullif(Body, '') AS Body, Score::BIGINT AS Score,
  g AS OwnerUserId, AcceptedAnswerId, ClosedDate, AnswerCount,
  CASE WHEN {SPLIT_HASH} < 'b3333333' THEN 'train' ELSE 'test' END AS side FROM keyed"""),
    "structured_features": """
WITH o AS (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price FROM orders),
i AS (SELECT *, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM o)) AS filled FROM o),
z AS (SELECT *, (filled - (SELECT avg(filled) FROM i)) / (SELECT stddev_pop(filled) FROM i) AS scaled FROM i)
SELECT o_orderkey, 'structured_processing__' || slot AS slot, round(value, 6) AS value FROM (
  SELECT o_orderkey, 'num__price' AS slot, scaled AS value FROM z
  UNION ALL SELECT o_orderkey, 'cat__o_orderpriority_' || k.v, CASE WHEN o_orderpriority = k.v THEN 1.0::DOUBLE ELSE 0 END
    FROM z CROSS JOIN (SELECT DISTINCT o_orderpriority AS v FROM orders) k
  UNION ALL SELECT o_orderkey, 'cat__o_orderstatus_' || k.v, CASE WHEN o_orderstatus = k.v THEN 1.0::DOUBLE ELSE 0 END
    FROM z CROSS JOIN (SELECT DISTINCT o_orderstatus AS v FROM orders) k
  UNION ALL SELECT o_orderkey, 'date__o_orderdate_year', year(o_orderdate)::DOUBLE FROM z
  UNION ALL SELECT o_orderkey, 'date__o_orderdate_month', month(o_orderdate)::DOUBLE FROM z
  UNION ALL SELECT o_orderkey, 'date__o_orderdate_day', day(o_orderdate)::DOUBLE FROM z)""",
    "knn_graph": """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS neighbor, list_distance(a.v, b.v) AS distance FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, neighbor, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor) AS rank, round(distance, 6) AS distance
FROM d QUALIFY rank <= 15""",
    "knn_graph_cosine": """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS neighbor, list_cosine_distance(a.v, b.v) AS distance FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, neighbor, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor) AS rank, round(distance, 6) AS distance
FROM d QUALIFY rank <= 15""",
    "train_random_forest": _predicted(),
    "train_logistic": _predicted(),
    "predict_quality": sql("posts", "SELECT Id, 1::BIGINT AS answered FROM posts"),
    "train_evaluate": f"""
WITH t AS ({_predicted()}),
s AS (SELECT unnest(['load', 'features', 'training', 'evaluation', 'saving']) AS name)
SELECT 'stage' AS part, name, 1::BIGINT AS n FROM s
UNION ALL SELECT 'support', CASE label WHEN 1 THEN 'High Quality' ELSE 'Low Quality' END, count(*) FROM t GROUP BY label
UNION ALL SELECT 'support', unnest(['accuracy', 'macro avg', 'weighted avg']), count(*) FROM t
UNION ALL SELECT 'matrix', CAST(label AS VARCHAR), count(*) FROM t GROUP BY label
UNION ALL SELECT 'check', unnest(['follows', 'out of bag']), 1""",
    "project_2d": """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS neighbor, list_distance(a.v, b.v) AS distance FROM e a JOIN e b ON a.vec_id <> b.vec_id),
g AS (SELECT vec_id, neighbor FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor) <= 15),
u AS (SELECT vec_id, neighbor FROM g UNION SELECT neighbor, vec_id FROM g)
SELECT vec_id, count(*) AS degree, 1::BIGINT AS centred, 1::BIGINT AS orthogonal, 1::BIGINT AS settled FROM u GROUP BY vec_id""",
    "project_linear_axes": "SELECT vec_id, 1::BIGINT AS centred, 1::BIGINT AS orthogonal FROM embeddings",
    "post_map": sql("posts", """
SELECT Id, coalesce(Title, 'No Title') AS Title, CAST(Score AS VARCHAR) AS Score,
  CASE WHEN AnswerCount > 0 THEN 'Answered' ELSE 'Unanswered' END AS cluster, '{}' AS label_store, 1::BIGINT AS placed
FROM posts WHERE PostTypeId = 1"""),
    "save_model": sql("posts", "SELECT Id, 1::BIGINT AS same FROM posts"),
    "post_map_rows": sql("posts", """
SELECT Id, coalesce(Title, 'No Title') AS Title, CAST(Score AS VARCHAR) AS Score,
  CASE WHEN AnswerCount > 0 THEN 'Answered' ELSE 'Unanswered' END AS cluster, '{}' AS label_store FROM posts WHERE PostTypeId = 1"""),
    "save_model_metadata": sql("posts", """
SELECT 'random_forest' AS model_type, 'quality_based' AS label_type, CAST(NULL AS DOUBLE) AS median_threshold, 1::BIGINT AS dated
UNION ALL SELECT 'random_forest', 'score_based', CAST(quantile_cont(Score, 0.5) AS DOUBLE), 1 FROM posts"""),
    "feature_matrix_full_width": _full_width(),
    "fit_train_apply_test_full_width": _full_width(_side("train"), _side("test")),
    "feature_names": f"""
WITH d AS (SELECT least(max(len(embedding)), {fixed.SVD_COMPONENTS}) AS n FROM embeddings)
SELECT i AS slot, 'text_processing__truncatedsvd' || i AS name FROM (SELECT unnest(range(n)) AS i FROM d)
UNION ALL
SELECT n + i, 'quality_processing__' || name FROM d CROSS JOIN (
  SELECT unnest(range(7)) AS i, unnest([{", ".join(f"'{c}'" for c in fixed.QUALITY_FEATURES)}]) AS name)""",
}
