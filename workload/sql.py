"""DuckDB SQL with the result each query must have."""

from __future__ import annotations

from postmill.operators import scoring
from workload.mail import MAIL_SQL, ORGANISATION, OWN_ADDRESS


_LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZéóèñüçäöêßíÉÈÑÓÇÊÜÖÄÍ"
_CYRILLIC = "абцдефгхийклмнопщрстувшжызАБЦДЕФГХИЙКЛМНОПЩРСТУВШЖЫЗэоеньюяяёьиЭЕНОЦЁЮЯЯИ"
_KATAKANA = "アベツデエフグヒイジクルムノオプキリストウヴワザヨゼアベツデエフグヒイジクルムノオプキリストウヴワザヨゼエオエノウツアオエスイエエノオツエウオアイ"


def quoted(text: str) -> str:
    """A text as SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def mail(select: str, recursive: bool = False) -> str:
    """The mail view followed by a select, or by a comma and further table expressions."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{MAIL_SQL}\n{select}"


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def grams(t: str, n: int) -> str:
    return (
        f"list_transform(range(1, len({t}) - {n - 2}), lambda i: array_to_string({t}[i:i + {n - 1}], ' '))"
        if n > 1
        else t
    )


#: What the pages hold: hidden parts, blocks, headings, one level of bullets, four references. Written for SQL alone.
_PAGE_STEPS = (
    ("<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<head\\b.*?</head\\s*>", "", "gis"),
    ("[ \\t\\r\\n]+", " ", "g"),
    ("<br\\s*/?>", "\n", "gi"),
    ("<li\\b[^>]*>", "\n\x03* ", "gi"),
    ("</?(p|div|article|footer|nav|ul|body|html)\\b[^>]*>|</h1>", "\n\n", "gi"),
    ("<h1\\b[^>]*>", "\n\n# ", "gi"),
    ("<[^>]*>", "", "g"),
)


def html(column: str) -> str:
    text = column
    for pattern, replacement, flags in _PAGE_STEPS:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(replacement)}, '{flags}')"
    for name, letter in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{letter}')"
    for pattern, replacement in (("[ \\t]+\n", "\n"), ("\n[ \\t]+", "\n"), ("\n{3,}", "\n\n"), ("\x03", "  ")):
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


# After one of these at the start of a line, a mail is quoted text or a signature.
_CUTS = (
    "-- \\n",
    "--\\n",
    "-----Original Message-----",
    "________________________________",
    "On .* wrote:",
    "From: ",
    "Sent from my iPhone",
)
_EXTERNAL = (
    "CAUTION: This email originated from outside of the organization. Do not click links or open "
    "attachments unless you recognize the sender and know the content is safe"
)
_OUTSIDE = (
    f"CAUTION: This email originated from outside {ORGANISATION}. Do not click any links or open "
    "attachments unless you are sure of the safety of the contents."
)


def clean(column: str, banners: tuple[str, ...] = (_EXTERNAL,)) -> str:
    pattern = quoted("(?ms)" + "|".join(f"^{m}.*" for m in _CUTS))
    cut = f"regexp_replace({column}, {pattern}, '')"
    text = (
        f"CASE WHEN length({cut}) < length({column}) THEN regexp_replace({cut}, '^\\s+|\\s+$', '', 'g') ELSE {column} END"
    )
    text = f"regexp_replace({text}, '[\\n\\r\\t| -]+', ' ', 'g')"
    for banner in banners:
        text = f"regexp_replace({text}, {quoted(banner)}, '', 'g')"
    return f"CASE WHEN trim({text}) = '' THEN '' ELSE {text} END"


CLEAN_MAIL = clean("body")
CLEANED = f"cleaned AS (SELECT *, {CLEAN_MAIL} AS clean_text FROM dom)"
PARENTS = "parents AS (SELECT message_id AS pid, min(submit_time) AS pt FROM mail GROUP BY 1)"
RESPONSE = "epoch_us(m.submit_time) / 1000000.0 - epoch_us(p.pt) / 1000000.0"
REQUESTED = "SELECT DISTINCT previous_message_id AS message_id FROM mail WHERE previous_message_id IS NOT NULL"

# The patterns of the entities, as RE2 has them, in the order of the output.
_PATTERNS = (
    ("QID", r"\b[0-9]{11}\b"),
    ("Mobile Number", r"\+?[0-9]{1,4}[\s-]?[0-9]{1,4}[\s-]?[0-9]{6,10}"),
    ("Account Number", r"\b[0-9]{8,12}\b"),
    ("Passport Number", r"\b[A-Z0-9]{5,9}\b"),
    ("Email Address", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"),
    ("IBAN", r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{1,30}\b"),
    ("Transaction Amount", r"\b[\$|QAR|USD|EUR]?\s?[0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{2})?\b"),
    ("Transaction Date", r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"),
    ("Date of Birth", r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"),
)


def entity_rows(text: str) -> str:
    """All entities of a text. RE2's borders know ASCII alone, so other letters, of which no match may hold one, become
    underscores, which are letters to a border; for addresses, which may hold underscores, the word that they begin goes.
    """
    other = {t: f"regexp_replace({text}, '[^\\x00-\\x7F]', '_', 'g')" for t, _ in _PATTERNS}
    other["Email Address"] = f"regexp_replace({text}, '[^\\x00-\\x7F]+\\w*', ' ', 'g')"
    return " || ".join(f"list_transform(regexp_extract_all({other[t]}, {quoted(p)}), lambda v: {{'t': {quoted(t)}, 'v': v}})" for t, p in _PATTERNS)


def learned(scale: str, out: str) -> str:
    """One-against-rest naive Bayes over the different words of a text; ``scale`` makes scores of probabilities ``p``."""
    return f"""
WITH l AS (SELECT unnest(['lang_de', 'lang_en', 'lang_es', 'lang_fr', 'toxic', 'junk', 'never_seen']) AS label),
ex AS (
  SELECT doc_id, text, ['lang_' || lang, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality = 0 THEN 'junk' END] AS marks
  FROM documents JOIN labels USING (doc_id)),
sizes AS (SELECT label, count(*) FILTER (list_contains(marks, label)) AS n, count(*) AS every FROM ex, l GROUP BY 1),
words AS (SELECT marks, unnest(list_distinct({tokens("text")})) AS w FROM ex),
counts AS (SELECT label, w, count(*) FILTER (list_contains(marks, label)) AS n, count(*) AS every FROM words, l GROUP BY 1, 2),
totals AS (SELECT label, sum(n) + count(*) AS own, sum(every - n) + count(*) AS rest FROM counts GROUP BY 1),
weights AS (SELECT label, w, round((ln((n + 1) / own) - ln((every - n + 1) / rest)) * 1000000) AS s FROM counts JOIN totals USING (label)),
found AS (SELECT doc_id, unnest(list_distinct({tokens("text")})) AS w FROM documents),
sums AS (SELECT doc_id, label, sum(s) AS s FROM found JOIN weights USING (w) GROUP BY 1, 2),
single AS (
  SELECT doc_id, label, 1 / (1 + exp(-(round(ln((n + 1) / (every - n + 1)) * 1000000) + coalesce(s, 0)) / 1000000)) AS p
  FROM documents CROSS JOIN sizes LEFT JOIN sums USING (doc_id, label)),
scaled AS (SELECT doc_id, label, {scale} AS score FROM single)
SELECT d.doc_id, label AS {out} FROM documents d LEFT JOIN (SELECT * FROM scaled WHERE score > 0.09) USING (doc_id)"""


def bayes(examples: str, docs: str, key: str, features: str, first: str, out: str) -> str:
    """Naive Bayes in SQL. ``examples`` has (label, id, text), ``docs`` (key, text)."""
    return f"""
WITH examples AS ({examples}), docs AS ({docs}),
labels AS (SELECT label, count(*) AS n FROM examples GROUP BY 1),
priors AS (SELECT label, round(ln(n / (SELECT sum(n) FROM labels)) * 1000000) AS prior FROM labels),
counts AS (SELECT label, feature, count(*) AS n FROM (SELECT label, unnest({features}) AS feature FROM examples) GROUP BY 1, 2),
vocabulary AS (SELECT DISTINCT feature FROM counts),
full_counts AS (
  SELECT l.label, v.feature, coalesce(c.n, 0) AS n FROM labels l, vocabulary v
  LEFT JOIN counts c ON c.label = l.label AND c.feature = v.feature),
totals AS (SELECT label, sum(n) AS t FROM full_counts GROUP BY 1),
weights AS (
  SELECT f.label, feature, round(ln((n + 1) / (t + (SELECT count(*) FROM vocabulary))) * 1000000) AS w
  FROM full_counts f JOIN totals USING (label)),
doc_features AS (SELECT {key}, feature, count(*) AS n FROM (SELECT {key}, unnest({features}) AS feature FROM docs) GROUP BY 1, 2),
sums AS (SELECT {key}, label, sum(n * w) AS s FROM doc_features JOIN weights USING (feature) GROUP BY 1, 2),
scores AS (
  SELECT d.{key}, p.label, prior + coalesce(s, 0) AS score FROM (SELECT DISTINCT {key} FROM docs) d, priors p
  LEFT JOIN sums ON sums.{key} = d.{key} AND sums.label = p.label),
best AS (SELECT {key}, label, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, label) AS r FROM scores)
SELECT {key}, {first} AS {out} FROM best WHERE r = 1"""


LETTER_PAIRS = (
    "list_filter(list_transform(list_zip(string_split(lower(text), ''), string_split(lower(text), '')[2:]),"
    " lambda z: z[1] || coalesce(z[2], '')), lambda g: regexp_full_match(g, '\\p{L}{2}'))"
)


def shares(labels: list[str], competing: bool, out: str) -> str:
    """Label shares in SQL over the clean mails."""
    values = ", ".join(
        f"({quoted(label)}, [{', '.join(quoted(w) for w in scoring.label_words(label))}])" for label in labels
    )
    score = "share / nullif(sum(share) OVER (PARTITION BY message_id), 0)" if competing else "share"
    return mail(
        f""", {CLEANED}, labels(label, words) AS (VALUES {values}),
words AS (SELECT message_id, {tokens("clean_text")} AS t FROM cleaned),
shares AS (
  SELECT message_id, label, len(list_intersect(words, t)) / CAST(len(words) AS DOUBLE) AS share FROM words, labels),
scored AS (SELECT message_id, label, {score} AS score FROM shares),
kept AS (SELECT message_id, label FROM scored WHERE score > {scoring.THRESHOLD})
SELECT message_id, label AS {out} FROM (SELECT message_id FROM mail) LEFT JOIN kept USING (message_id)"""
    )


def word_frequencies(source: str, caps: dict[int, int]) -> str:
    """Top n-grams per topic; ``source`` has (topic_id, clean_text)."""
    parts = " UNION ALL ".join(
        f"SELECT topic_id, {n} AS n, {cap} AS cap, unnest({grams('t', n)}) AS word FROM tok" for n, cap in caps.items()
    )
    return f"""
tok AS (SELECT topic_id, {tokens("clean_text")} AS t FROM ({source})),
grams AS ({parts}),
counted AS (SELECT topic_id, n, cap, word, count(*) AS frequency FROM grams GROUP BY ALL),
frequent AS (
  SELECT *, row_number() OVER (PARTITION BY topic_id, n ORDER BY frequency DESC, word) AS r FROM counted)"""


DESCRIBED = (
    "described AS (SELECT topic_id FROM mail WHERE topic_id <> -1 GROUP BY 1 HAVING count(*) >= 5)"
)

#: The vectors of one label lie together, and apart from all others.
LABEL_CLUSTERS = """
SELECT vec_id, min(vec_id) OVER (PARTITION BY label) AS cluster_id, count(*) OVER (PARTITION BY label) AS cluster_size FROM embeddings"""

SQL: dict[str, str] = {
    "entry": mail(
        f""", {PARENTS}
SELECT sender_domain, count(*) AS mails,
  count(CASE WHEN m.refs IS NOT NULL OR m.previous_message_id IS NOT NULL THEN 1 END) AS in_thread,
  count(p.pt) AS answers, round(avg({RESPONSE}), 4) AS mean_response
FROM dom m LEFT JOIN parents p ON p.pid = m.previous_message_id
WHERE NOT is_internal AND from_address <> '{OWN_ADDRESS}' GROUP BY 1"""
    ),
    "raw_mail": mail(
        """SELECT m.message_id, subject, subject_prefix, submit_time, submit_time AS delivery_time,
  from_address, to_address, array_to_string(cc, ', ') AS cc_address, previous_message_id,
  array_to_string(m.refs, ', ') AS "references",
  regexp_replace(text, '\\s+', ' ', 'g') AS plain_text_body,
  CASE WHEN turn % 2 = 1 THEN regexp_replace('<p>' || text || '</p>', '\\s+', ' ', 'g') END AS html_body
FROM mail m JOIN conv USING (conv_id, turn)"""
    ),
    "fetch_by_ids": mail(
        """SELECT message_id, subject, submit_time FROM mail WHERE message_id IN (
  SELECT m.previous_message_id FROM mail m JOIN conversations c USING (conv_id, turn) WHERE role = 'assistant')"""
    ),
    "ids_not_found": mail(f"{REQUESTED} AND previous_message_id NOT IN (SELECT message_id FROM mail)"),
    "request_counts": mail(
        f"""SELECT count(*) AS requested, count(m.message_id) AS found
FROM ({REQUESTED}) r LEFT JOIN mail m USING (message_id)"""
    ),
    "fetch_since": "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'",
    "fetch_since_by_day": "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'",
    "fetch_missing": mail(
        """, every AS (SELECT *, conv_id + turn AS n FROM mail),
archive AS (SELECT * FROM every WHERE n % 4 = 3),
server AS (SELECT * FROM every WHERE n % 11 <> 5),
asked(id) AS (
  SELECT previous_message_id FROM archive WHERE previous_message_id NOT IN (SELECT message_id FROM archive)
    AND (subject_prefix IS NULL OR NOT contains(subject_prefix, 'fw'))
  UNION SELECT previous_message_id FROM asked JOIN server ON message_id = id
  WHERE previous_message_id NOT IN (SELECT message_id FROM archive) AND (subject_prefix IS NULL OR NOT contains(subject_prefix, 'fw')))
SELECT id AS message_id, CASE WHEN message_id IS NULL THEN 'not found' ELSE 'fetched' END AS state, subject, body AS plain_text_body
FROM asked LEFT JOIN server ON message_id = id""",
        recursive=True,
    ),
    "union_sources": mail(
        """SELECT message_id, subject, 'archive' AS origin, NULL::TIMESTAMP AS submit_time FROM mail
UNION ALL SELECT message_id, NULL, 'server', submit_time FROM mail"""
    ),
    "sample_first_n": mail("SELECT message_id, subject, submit_time FROM mail ORDER BY submit_time, message_id LIMIT 500"),
    "load_project": mail(
        f""", {CLEANED}
SELECT message_id, CAST(-1 AS INTEGER) AS topic_id, false AS is_spam, subject, subject_prefix, submit_time,
  body AS plain_text_body, from_name, previous_message_id, refs IS NULL AS first_in_thread,
  CAST(len(refs) AS INTEGER) AS num_previous_messages, refs[1] AS thread_id, sender_domain, is_internal, clean_text
FROM cleaned"""
    ),
    "ensure_parents": """
WITH parents AS (SELECT c_custkey AS custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0)
SELECT * FROM parents UNION ALL
SELECT DISTINCT o_custkey, NULL, NULL FROM orders WHERE o_custkey NOT IN (SELECT custkey FROM parents)""",
    "null_normalise": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
  CASE WHEN value <= 50 THEN value END AS value FROM events""",
    "source_counts": "SELECT source, count(*) AS messages FROM documents GROUP BY 1",
    "parse_addresses": mail(
        """SELECT conv_id, turn, from_address AS "from", to_address AS "to", array_to_string(cc, ', ') AS cc,
  '"user, ' || conv_id || '"@ext.example, x@z.example' AS bcc FROM mail"""
    ),
    "parse_identifiers": mail(
        """SELECT conv_id, turn, message_id, previous_message_id AS previous, array_to_string(refs, ', ') AS refs FROM mail"""
    ),
    "charset": """
SELECT doc_id, CASE lang WHEN 'en' THEN 'us-ascii' WHEN 'fr' THEN 'utf-8' WHEN 'de' THEN source END AS charset
FROM documents""",
    "subject_prefix": """
SELECT conv_id, turn, CASE turn % 6 WHEN 0 THEN 're:' WHEN 1 THEN 'fwd:' WHEN 2 THEN 'fw:'
  ELSE nullif(regexp_extract(lower(trim(['FD: ', 'Re ', 'answer: re: '][turn % 6 - 2] || text)), '^(?:re|fwd?|fw):'), '')
  END AS prefix FROM conversations""",
    "parse_body": "SELECT doc_id, nullif(text, '') AS body FROM documents",
    "detect_charset": f"""
WITH t AS (
  SELECT doc_id, doc_id // 2 % 6 AS kind, doc_id % 2 = 1 AS undeclared,
    CASE WHEN doc_id // 2 % 6 IN (1, 2, 5) THEN translate(text, {quoted(_LATIN)}, {quoted(_CYRILLIC)})
      WHEN doc_id // 2 % 6 = 3 THEN translate(text, {quoted(_LATIN)}, {quoted(_KATAKANA)}) ELSE text END AS body
  FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN body = '' THEN NULL WHEN undeclared AND kind < 4 AND NOT regexp_matches(body, '[^\\x00-\\x7F]') THEN 'utf-8'
    ELSE ['windows-1252', 'windows-1251', 'koi8-r', 'shift_jis', 'utf-16-le', 'utf-16-be'][kind + 1] END AS charset,
  nullif(body, '') AS body
FROM t""",
    "filetime": """
SELECT event_id, CASE WHEN value <= 50 THEN make_timestamp(CAST(
  (event_id * 987654321017 + 133380360000000005) // 10 - 11644473600000000 AS BIGINT)) END AS sent FROM events""",
    "rfc2822_time": mail(
        "SELECT conv_id, turn, submit_time, submit_time AS delivery_time, NULL::TIMESTAMP AS broken FROM mail"
    ),
    "header_map": mail(
        """SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS x_case, trim(subject) AS subject, from_address,
  array_to_string(refs, ', ') AS refs, 4 AS names FROM mail"""
    ),
    "from_name": mail("SELECT conv_id, turn, from_name FROM mail"),
    "html_to_text": f"SELECT page_id, {html('html')} AS body FROM pages",
    "html_structure": f"""
SELECT page_id, '3. Item ' || page_id || chr(10) || '    * ' || url || chr(10) || '    * inner ' || (page_id % 7) || chr(10) || '  4. two < 3 & four'
  || chr(10) || chr(10) || '> first “quote” of ' || page_id || chr(10) || '>' || chr(10) || '> > deeper é' || chr(10) || '>' || chr(10) || '> after ’ 𝄞 &unknown;'
  || chr(10) || chr(10) || CASE WHEN starts_with(body, '* ') THEN '  ' ELSE '' END || body AS body
FROM (SELECT page_id, url, {html("html")} AS body FROM pages)""",
    "fill_plain_text": f"""
WITH rows AS (
  SELECT page_id, CASE WHEN starts_with(url, 'https') THEN url END AS plain,
    CASE WHEN NOT contains(url, 'example.org') THEN html END AS html FROM pages)
SELECT page_id, coalesce(plain, {html("html")}) AS plain_text_body, plain IS NULL AND html IS NOT NULL AS plain_text_is_converted
FROM rows""",
    "sender_domain": mail("SELECT message_id, sender_domain FROM dom"),
    "all_domains": mail("SELECT message_id, array_to_string(all_domains, ', ') AS all_domains FROM dom"),
    "is_internal": mail("SELECT message_id, is_internal FROM dom"),
    "ts_ntz": "SELECT event_id, ts - INTERVAL 3 HOURS AS ts_utc FROM events",
    "threading": mail(
        """SELECT message_id, refs IS NULL AND previous_message_id IS NULL AS first_in_thread,
  CAST(len(refs) AS INTEGER) AS num_previous_messages, refs[1] AS thread_id FROM mail"""
    ),
    "missing_ids": mail(
        """, wanted AS (
  SELECT unnest(list_distinct(coalesce(refs, CAST([] AS VARCHAR[])) || [previous_message_id])) AS message_id FROM mail
  WHERE subject_prefix IS NULL OR NOT contains(subject_prefix, 'fw'))
SELECT DISTINCT message_id FROM wanted WHERE message_id IS NOT NULL AND message_id NOT IN (SELECT message_id FROM mail)"""
    ),
    "response_time": mail(
        f""", {PARENTS}
SELECT message_id, {RESPONSE} AS response_time FROM mail m LEFT JOIN parents p ON p.pid = m.previous_message_id"""
    ),
    "response_time_events": """
SELECT CAST(e.event_id AS VARCHAR) AS message_id, (epoch_us(e.ts) - epoch_us(p.ts)) / 1000000.0 AS response_time
FROM events e LEFT JOIN events p ON p.event_id = CASE WHEN e.event_type = 'error' THEN 0 ELSE e.event_id - 150 END""",
    "clean_text": mail(f", {CLEANED} SELECT message_id, clean_text FROM cleaned"),
    "clean_documents": f"SELECT doc_id, {clean('text', (_OUTSIDE, _EXTERNAL))} AS clean_text FROM documents",
    "drop_empty": f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS text, unnest(range(0, len(l))) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
cleaned AS (SELECT doc_id, CAST(line AS INTEGER) AS line, {clean("text")} AS clean_text FROM lines)
SELECT * FROM cleaned WHERE clean_text <> ''""",
    "language": bayes(
        "SELECT lang AS label, text FROM documents",
        "SELECT doc_id, text FROM documents",
        "doc_id",
        LETTER_PAIRS,
        "CASE WHEN label IN ('la', 'qu') THEN 'en' ELSE label END",
        "language",
    ),
    "ngrams": f"""
WITH tok AS (SELECT {tokens("text")} AS t FROM conversations),
g AS (SELECT unnest({grams("t", 2)}) AS gram FROM tok)
SELECT gram, count(*) AS n FROM g GROUP BY 1""",
    "external_only": mail(
        f"SELECT message_id, sender_domain FROM dom WHERE NOT is_internal AND from_address <> '{OWN_ADDRESS}'"
    ),
    "dedupe": mail("SELECT message_id, turn, submit_time, CAST(-1 AS INTEGER) AS topic_id, false AS is_spam FROM mail"),
    "drop_spam": mail("SELECT message_id, subject, false AS is_spam FROM mail WHERE conv_id % 5 <> 2"),
    "attach_topic": mail("SELECT message_id, subject, topic_id FROM mail"),
    "topic_dim": mail("SELECT DISTINCT topic_id, 'topic ' || topic_id AS topic_description FROM mail"),
    "topic_messages": mail("SELECT message_id, topic_id, 'topic ' || topic_id AS topic_description FROM mail"),
    "addresses": mail(
        """SELECT message_id, 'from' AS address_type, from_address AS address FROM mail
UNION ALL SELECT message_id, 'to', to_address FROM mail
UNION ALL SELECT message_id, 'cc', unnest(cc) FROM mail"""
    ),
    "references": mail("SELECT message_id, unnest(refs) AS reference_message_id FROM mail"),
    "domains": mail("SELECT message_id, unnest(all_domains) AS domain FROM dom"),
    "message_children": mail(
        f""", a AS (SELECT message_id, 'from' AS address_type, from_address AS address FROM mail
UNION ALL SELECT message_id, 'to', to_address FROM mail
UNION ALL SELECT message_id, 'cc', unnest(cc) FROM mail)
SELECT a.*, subject FROM a JOIN dom USING (message_id) WHERE NOT is_internal AND from_address <> '{OWN_ADDRESS}'"""
    ),
    "top_topics": mail(
        """SELECT topic_id, count(*) AS messages, 'topic ' || topic_id AS topic_description
FROM mail GROUP BY 1 ORDER BY messages DESC, topic_id LIMIT 10"""
    ),
    "entities_regex": f"""
WITH made AS (SELECT doc_id, text || format(' É{{0:08d}} {{0:08d}} {{0:08d}}ß ñQ7{{0:06d}} Q7{{0:06d}}', doc_id) AS text FROM documents),
found AS (SELECT doc_id, unnest({entity_rows("text")}) AS e FROM made)
SELECT doc_id, e.t AS entity_type, e.v AS entity_value FROM found""",
    "entities_exploded": mail(
        f""", found AS (SELECT message_id, unnest({entity_rows("body")}) AS e FROM mail)
SELECT message_id, e.t AS entity_type, e.v AS entity_value FROM mail LEFT JOIN found USING (message_id)"""
    ),
    "entities_json": """
WITH e AS (SELECT event_id, event_id % 6 AS kind, event_type, CAST(user_id AS VARCHAR) AS u, format('{:.2f}', value) AS v FROM events)
SELECT event_id, 'Full Name' AS entity_type, 'user ' || u AS entity_value FROM e WHERE kind = 0
UNION ALL SELECT event_id, 'Transaction Amount', regexp_replace(v, '\\.?0+$', '') FROM e WHERE kind = 0
UNION ALL SELECT event_id, 'Transaction Amount', v FROM e WHERE kind = 0
UNION ALL SELECT event_id, 'IBAN', 'X' || u FROM e WHERE kind = 1
UNION ALL SELECT event_id, NULL, NULL FROM e WHERE kind IN (2, 3, 4)
UNION ALL SELECT event_id, 'Mobile Number', u FROM e WHERE kind = 5
UNION ALL SELECT event_id, 'Mobile Number', event_type FROM e WHERE kind = 5""",
    "build_prompt": "SELECT doc_id, {} || text || {} AS prompt FROM documents".format(
        *map(quoted, scoring.SPAM_PROMPT.split("{text}"))
    ),
    "invoke_model": "SELECT doc_id, source, length(text) || ': ' || text AS response FROM documents",
    "invoke_concurrently": "SELECT doc_id, source, length(text) || ': ' || text AS response FROM documents",
    "spam_flag": bayes(
        "SELECT CASE WHEN toxic = 1 THEN 'spam' ELSE 'ham' END AS label, text FROM documents JOIN labels USING (doc_id)",
        "SELECT doc_id, text FROM documents",
        "doc_id",
        tokens("text"),
        "label = 'spam'",
        "is_spam",
    ),
    "spam_response": "SELECT event_id, event_id % 4 IN (0, 3) AS is_spam FROM events",
    "categories": shares(scoring.CATEGORIES, True, "category"),
    "products": shares(scoring.PRODUCTS, False, "product"),
    "categories_learned": learned("p / sum(p) OVER (PARTITION BY doc_id)", "category"),
    "products_learned": learned("p", "product"),
    "summaries": f"""
WITH split AS (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda s: trim(regexp_replace(s, '\\s+', ' ', 'g'))), lambda s: s <> '') AS p
  FROM documents),
parts AS (SELECT doc_id, unnest(p) AS s, unnest(range(0, len(p))) AS pos FROM split),
words AS (SELECT doc_id, pos, unnest({tokens("s")}) AS w FROM parts),
freq AS (SELECT doc_id, w, count(*) AS f FROM words GROUP BY 1, 2),
scored AS (SELECT doc_id, pos, sum(f) / CAST(count(*) AS DOUBLE) AS score FROM words JOIN freq USING (doc_id, w) GROUP BY 1, 2),
best AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS r FROM scored),
chosen AS (SELECT doc_id, string_agg(s || '.', ' ' ORDER BY pos) AS summary FROM best JOIN parts USING (doc_id, pos)
  WHERE r <= 3 GROUP BY 1)
SELECT doc_id, coalesce(summary, '') AS summary FROM documents LEFT JOIN chosen USING (doc_id)""",
    "populate_missing": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
    "l2_normalise": """
WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM embeddings)
SELECT vec_id, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS pos,
  round(unnest(list_transform(embedding, lambda x: CASE WHEN norm > 0 THEN x::DOUBLE / norm ELSE x::DOUBLE END)), 5) + 0.0 AS x FROM n""",
    "density_cut": LABEL_CLUSTERS,
    "topics": LABEL_CLUSTERS,
    "svd_full": """
SELECT a.vec_id, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)), 4) + 0.0 AS product
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "svd_wide": """
SELECT a.vec_id, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)), 4) + 0.0 AS product
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "embed_lengths": f"SELECT doc_id, CASE WHEN len({tokens('text')}) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS length FROM documents",
    "describable_topics": mail(
        f", {DESCRIBED} SELECT message_id, topic_id FROM mail WHERE topic_id IN (SELECT topic_id FROM described)"
    ),
    "topic_samples": mail(
        f""", {CLEANED}, {DESCRIBED},
ranked AS (SELECT message_id, topic_id, clean_text,
  CAST(row_number() OVER (PARTITION BY topic_id ORDER BY message_id) AS INTEGER) AS sample FROM cleaned)
SELECT * FROM ranked WHERE sample <= 3 AND topic_id IN (SELECT topic_id FROM described)"""
    ),
    "topic_descriptions": mail(
        f""", {CLEANED}, {DESCRIBED}, {word_frequencies("SELECT topic_id, clean_text FROM cleaned", {1: 3})}
SELECT topic_id, string_agg(word, ', ' ORDER BY r) AS topic_description FROM frequent
WHERE r <= cap AND topic_id IN (SELECT topic_id FROM described) GROUP BY 1"""
    ),
    "word_frequencies": f"""
WITH {word_frequencies("SELECT CAST(CASE lang WHEN 'de' THEN -1 WHEN 'en' THEN 0 WHEN 'es' THEN 1 ELSE 2 END AS INTEGER) AS topic_id, text AS clean_text FROM documents", {1: 12, 2: 4, 3: 2})}
SELECT topic_id, word, frequency FROM frequent WHERE r <= cap""",
}

_ADDRESS_ROWS = mail(
    """, a AS (SELECT message_id, 'from' AS address_type, from_address AS address FROM mail
UNION ALL SELECT message_id, 'to', to_address FROM mail
UNION ALL SELECT message_id, 'cc', unnest(cc) FROM mail),
rows AS (
  SELECT CASE WHEN address <> 'noreply@corp.example' THEN message_id END AS message_id,
    CASE WHEN starts_with(address, 'b1@') THEN 'copy' ELSE address_type END AS address_type,
    CASE WHEN starts_with(address, 'a1') THEN repeat(address, 40) ELSE address END AS address FROM a),
checked AS (
  SELECT *, CASE WHEN message_id IS NULL THEN 'message_id is null' WHEN length(address) > 255 THEN 'address is too long'
    WHEN address_type = 'copy' THEN 'address_type is unknown' END AS reject_reason FROM rows)
SELECT """
)
SQL["load_rejects"] = _ADDRESS_ROWS + "* FROM checked WHERE reject_reason IS NOT NULL"
SQL["load_accepted"] = _ADDRESS_ROWS + "* EXCLUDE (reject_reason) FROM checked WHERE reject_reason IS NULL"
SQL["load_conflicts"] = """
WITH batch AS (SELECT DISTINCT o_custkey AS topic_id, o_orderstatus AS topic_description FROM orders),
digests AS (
  SELECT *, sha256('{"topic_id":' || topic_id || ',"topic_description":"' || topic_description || '"}') AS d FROM batch)
SELECT topic_id, topic_description, CASE
  WHEN topic_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) THEN 'topic_id is stored already'
  WHEN d <> min(d) OVER (PARTITION BY topic_id) THEN 'topic_id is repeated' END AS reject_reason FROM digests"""
