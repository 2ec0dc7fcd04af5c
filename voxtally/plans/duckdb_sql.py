"""SQL for each registered query, written independently of the Spark expressions.

Where Spark compares padded text, this uses regular expressions with word
boundaries; where Spark stays inside one row with arrays, this unnests tokens
and looks back with window functions.  Both run over the same whole tables.
"""

from __future__ import annotations

from voxtally import dictionaries as d
from voxtally.operators.quant import DEFAULT_STOP_WORDS
from voxtally.plans.review_view import AIRLINES, SENTENCES, VIEW_KEY
from voxtally.rules import DEFAULT_RULES, RuleSet, Theme

_SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(q, values)) + "]"


def _in(values) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def _has(phrase: str) -> str:
    return f"regexp_matches(clean_text, {q(_bounded(phrase))})"


def _bounded(phrase: str) -> str:
    return r"\b" + phrase.replace(" ", r"\s+") + r"\b"


def _space(text: str) -> str:
    return f"trim(regexp_replace(coalesce({text}, ''), {q(_SPACE)}, ' ', 'g'))"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, {q('^' + _SPACE + '|' + _SPACE + '$')}, '', 'g')"


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0::DOUBLE ELSE round_even({part} / {whole} * 100, 2) END"


def _compact(items: list[str]) -> str:
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


# --- the view and its standard form ---------------------------------------

REVIEWS = f"""
raw AS (
  SELECT d.doc_id, d.source,
    list_extract({_list(AIRLINES)}, cast(d.doc_id % 8 + 1 AS INT)) AS airline,
    CASE WHEN d.n_chars % 5 = 0 THEN NULL ELSE 'Review' END AS review_title,
    CASE WHEN d.blank THEN ''
         ELSE concat(list_extract({_list(SENTENCES)}, cast(d.n_chars % 24 + 1 AS INT)), '. ', d.text) END AS review_text,
    CASE WHEN d.doc_id % 11 = 10 THEN NULL ELSE cast(1 + d.doc_id % 10 AS DOUBLE) END AS rating,
    CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE date '2024-01-01' + cast(d.doc_id % 700 AS INT) END AS review_date,
    d.doc_id % 50 = 0 AS is_synthetic,
    CASE d.doc_id % 4 WHEN 0 THEN 'Business' WHEN 1 THEN ' Solo  Leisure ' WHEN 2 THEN '' END AS traveler_type,
    CASE WHEN d.doc_id % 3 = 0 THEN 'PHX-ATL' END AS route,
    CASE d.doc_id % 5 WHEN 0 THEN 'Economy' WHEN 1 THEN '' ELSE 'First Class' END AS seat_type,
    CASE WHEN l.quality = 1 THEN 'yes' WHEN l.quality = 0 THEN '0' END AS recommended
  FROM (SELECT doc_id, source, n_chars, text, false AS blank FROM documents
        UNION ALL SELECT doc_id + 1000000000, source, n_chars, text, true FROM documents WHERE n_chars % 97 = 0) d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def _review_id(key: str, airline: str, date: str, title: str, body: str) -> str:
    parts = " || ' | ' || ".join(f"coalesce(cast({c} AS VARCHAR), 'nan')" for c in (airline, date, title, body))
    return f"{q(key + '_')} || substr(md5({q(key)} || ' | ' || {parts}), 1, 12)"


def _joined(title: str, body: str) -> str:
    return f"nullif(concat_ws(' | ', nullif({_strip(title)}, ''), nullif({_strip(body)}, '')), '')"


def _disruption(text: str) -> str:
    branches = " ".join(
        "WHEN " + " OR ".join(f"strpos({text}, {q(n)}) > 0" for n in needles) + f" THEN {q(label)}"
        for label, needles in d.DISRUPTION_RULES)
    return f"CASE WHEN {text} IN ('', 'nan') THEN NULL {branches} ELSE 'other' END"


def _flag(value: str) -> str:
    word = f"lower(trim({value}))"
    return f"CASE WHEN {word} IN {_in(d.TRUE_WORDS)} THEN true WHEN {word} IN {_in(d.FALSE_WORDS)} THEN false END"


def _airline(value: str) -> str:
    slug = _space(f"translate(lower({_space(value)}), '_-', '  ')")
    special = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in d.AIRLINE_NAMES.items())
    titled = (r"array_to_string(list_transform(regexp_extract_all(" + slug + r", '[^\p{L}]+|\p{L}+'), "
              "lambda w: upper(w[1]) || w[2:]), '')")
    return f"CASE {slug} WHEN '' THEN 'Unknown' {special} ELSE {titled} END"


def _label(value: str) -> str:
    text = f"lower({_space(value)})"
    known = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in d.DISRUPTION_LABELS.items())
    return f"CASE {text} {known} WHEN '' THEN 'unknown' ELSE {text} END"


STANDARD = REVIEWS + f""",
typed AS (
  SELECT *, {_joined('review_title', 'review_text')} AS raw_text,
    {_review_id(VIEW_KEY, 'airline', 'review_date', 'review_title', 'review_text')} AS review_id
  FROM raw
),
standard AS (
  SELECT *, {_disruption("lower(coalesce(raw_text, 'none'))")} AS disruption_type FROM typed
)"""

# --- cleaning --------------------------------------------------------------

PREPARED = STANDARD + f""",
fields AS (
  SELECT doc_id, review_id, source, {_airline('airline')} AS airline, review_date,
    strftime(review_date, '%Y-%m') AS review_month, rating, {_flag('recommended')} AS recommended,
    coalesce(is_synthetic, false) AS is_synthetic, {_label('disruption_type')} AS disruption_type,
    nullif({_space('traveler_type')}, '') AS traveler_type, nullif({_space('route')}, '') AS route,
    nullif({_space('seat_type')}, '') AS seat_type,
    {_space('review_title')} AS review_title, {_space('review_text')} AS review_text
  FROM standard
),
texts AS (
  SELECT *, concat_ws(' | ', nullif(review_title, ''), nullif(review_text, '')) AS analysis_text FROM fields
),
worded AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(analysis_text), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))
    AS clean_text
  FROM texts
),
prepared AS (
  SELECT *, CASE WHEN clean_text = '' THEN 0 ELSE len(string_split(clean_text, ' ')) END::INT AS word_count,
    length(analysis_text)::INT AS text_length
  FROM worded
)"""

_KEYWORDS = [w for words in d.DISRUPTION_KEYWORDS.values() for w in words]
CLEANED = PREPARED + f""",
kept AS (
  SELECT * FROM prepared WHERE clean_text <> '' AND word_count >= 4
  QUALIFY row_number() OVER (PARTITION BY clean_text ORDER BY doc_id) = 1
),
keyworded AS (
  SELECT *, {_compact([f"CASE WHEN {_has(w)} THEN {q(w)} END" for w in _KEYWORDS])} AS keywords FROM kept
),
cleaned AS (
  SELECT *, array_to_string(keywords, '; ') AS disruption_keywords_found,
    CASE WHEN rating IS NULL THEN 'unknown' WHEN rating <= 2 THEN 'low' WHEN rating = 3 THEN 'medium' ELSE 'high' END
      AS rating_bucket,
    coalesce(rating <= 2, false) OR coalesce(recommended = false, false)
      OR (disruption_type IN ('cancellation', 'refund', 'customer_support') AND len(keywords) >= 2)
      AS likely_negative_experience
  FROM keyworded
)"""

# --- themes ----------------------------------------------------------------


def _any(phrases) -> str:
    return r"\b(?:" + "|".join(p.replace(" ", r"\s+") for p in phrases) + r")\b"


def _theme_test(theme: Theme) -> str:
    tests = [f"regexp_matches(clean_text, {q(_any(theme.phrases))})"]
    tests += [f"regexp_matches(clean_text, {q(p.regex)})" for p in theme.patterns]
    test = "(" + " OR ".join(tests) + ")"
    if theme.suppressed_by:
        test = f"NOT regexp_matches(clean_text, {q(_any(theme.suppressed_by))}) AND {test}"
    return test


def _coded(rules: RuleSet) -> str:
    labels = [f"CASE WHEN {_theme_test(t)} THEN {q(t.label)} END" for t in rules.themes]
    return CLEANED + f""",
coded AS (SELECT *, {_compact(labels)} AS themes FROM cleaned)"""


def _evidence(rules: RuleSet) -> str:
    sections = []
    for t in rules.themes:
        items = [f"CASE WHEN {_has(p)} THEN {q(p)} END" for p in t.phrases]
        items += [f"CASE WHEN regexp_matches(clean_text, {q(p.regex)}) THEN {q('regex:' + p.regex)} END" for p in t.patterns]
        sections.append(f"CASE WHEN list_contains(themes, {q(t.label)}) THEN {q(t.label + ': ')} || "
                        f"array_to_string(list_sort(list_distinct({_compact(items)})), ', ') END")
    return f"array_to_string({_compact(sections)}, ' | ')"


def _theme_values(rules: RuleSet) -> str:
    rows = ", ".join(f"({i}, {q(t.label)}, {q(t.description)})" for i, t in enumerate(rules.themes))
    return f"theme_list(theme_order, theme, description) AS (VALUES {rows})"


# --- sentiment -------------------------------------------------------------

_SIGNALS = [
    ("rating <= 2", -120, "rating<=2"), ("rating >= 4", 80, "rating>=4"), ("recommended", 60, "recommended_true"),
    ("NOT recommended", -80, "recommended_false"),
    ("likely_negative_experience", -60, "likely_negative_experience"),
]


def _scored(rules: RuleSet) -> str:
    lexicon = rules.lexicon
    words = ", ".join(f"({q(w)}, {round(x * 100)})" for w, x in lexicon.word_weights.items())
    phrases = " + ".join(f"CASE WHEN {_has(p)} THEN {round(x * 100)} ELSE 0 END" for p, x in lexicon.phrase_weights.items())
    signals = " + ".join(f"CASE WHEN {test} THEN {points} ELSE 0 END" for test, points, _ in _SIGNALS)
    return _coded(rules) + f""",
lexicon(word, weight) AS (VALUES {words}),
tokens AS (
  SELECT doc_id, unnest(string_split(clean_text, ' ')) AS word,
    generate_subscripts(string_split(clean_text, ' '), 1) AS place
  FROM coded
),
contexts AS (
  SELECT *, lag(word, 1) OVER w AS before_1, lag(word, 2) OVER w AS before_2 FROM tokens
  WINDOW w AS (PARTITION BY doc_id ORDER BY place)
),
word_hits AS (
  SELECT doc_id, place, word, weight,
    coalesce(before_1 IN {_in(lexicon.negations)}, false) OR coalesce(before_2 IN {_in(lexicon.negations)}, false) AS negated
  FROM contexts JOIN lexicon USING (word)
),
word_points AS (
  SELECT doc_id, sum(CASE WHEN negated THEN -weight ELSE weight END)::BIGINT AS points FROM word_hits GROUP BY doc_id
),
pointed AS (
  SELECT coded.*, ({phrases} + {signals} + coalesce(points, 0))::BIGINT AS sentiment_points
  FROM coded LEFT JOIN word_points USING (doc_id)
),
scored AS (
  SELECT *, sentiment_points / 100.0::DOUBLE AS sentiment_score,
    CASE WHEN sentiment_points >= 100 THEN 'positive' WHEN sentiment_points <= -100 THEN 'negative' ELSE 'neutral' END
      AS sentiment_label
  FROM pointed
)"""


def _sentiment_evidence(rules: RuleSet) -> str:
    lexicon = rules.lexicon

    def group(table) -> str:
        return _compact([f"CASE WHEN {_has(p)} THEN {q(p)} END" for p in table])

    def words(rank: int, table) -> str:
        return (f"SELECT doc_id, CASE WHEN negated THEN 'negated:' || word ELSE word END AS item, {rank} AS part, place "
                f"FROM word_hits WHERE word IN {_in(table)}")

    def listed(rank: int, items: str) -> str:
        return f"SELECT doc_id, unnest({items}) AS item, {rank} AS part, generate_subscripts({items}, 1) AS place FROM scored"

    signals = _compact([f"CASE WHEN {test} THEN {q(name)} END" for test, _, name in _SIGNALS])
    return _scored(rules) + f""",
items AS (
  {listed(1, group(lexicon.positive_phrases))} UNION ALL {listed(2, group(lexicon.negative_phrases))}
  UNION ALL {words(3, lexicon.positive_words)} UNION ALL {words(4, lexicon.negative_words)}
  UNION ALL {listed(5, signals)}
),
firsts AS (SELECT doc_id, item, min(part::BIGINT * 1000000000 + place) AS first_at FROM items GROUP BY doc_id, item),
evidence AS (SELECT doc_id, string_agg(item, '; ' ORDER BY first_at) AS sentiment_evidence FROM firsts GROUP BY doc_id)
SELECT doc_id, coalesce(sentiment_evidence, '') AS sentiment_evidence FROM scored LEFT JOIN evidence USING (doc_id)"""


def _ngrams(stop_words) -> str:
    return f""",
negative AS (SELECT doc_id, clean_text FROM scored WHERE sentiment_label = 'negative'),
places AS (
  SELECT doc_id, unnest(string_split(clean_text, ' ')) AS word,
    generate_subscripts(string_split(clean_text, ' '), 1) AS place
  FROM negative
),
content AS (SELECT * FROM places WHERE length(word) > 1 AND word NOT IN {_in(stop_words)}),
grams AS (
  SELECT doc_id, word AS term FROM content
  UNION ALL
  SELECT doc_id, word || ' ' || next_word FROM (
    SELECT doc_id, word, lead(word) OVER (PARTITION BY doc_id ORDER BY place) AS next_word FROM content)
  WHERE next_word IS NOT NULL
),
least AS (SELECT CASE WHEN count(*) >= 500 THEN 3 WHEN count(*) >= 100 THEN 2 ELSE 1 END AS documents FROM negative)
SELECT term, count(*) AS count FROM grams GROUP BY term
HAVING count(DISTINCT doc_id) >= (SELECT documents FROM least)
ORDER BY count DESC, term LIMIT 40"""


_QUOTE = (r"CASE WHEN length(analysis_text) > {n} THEN regexp_replace(substr(analysis_text, 1, {m}), '\s+$', '') || '...' "
          "ELSE analysis_text END")


def _quotes(limit: int) -> str:
    quote = _QUOTE.format(n=280, m=277)
    order = "is_synthetic, distance, review_date DESC NULLS LAST, review_id"
    return f""",
candidates AS (
  SELECT unnest(themes) AS theme, review_id, airline, source, review_date, rating, is_synthetic,
    abs(text_length - 320) AS distance, {quote} AS quote_excerpt
  FROM coded
),
singled AS (
  SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY theme, quote_excerpt ORDER BY {order}) = 1
),
quotes AS (
  SELECT theme, row_number() OVER (PARTITION BY theme ORDER BY {order})::INT AS quote_rank, review_id, airline, source,
    review_date, rating, is_synthetic, quote_excerpt
  FROM singled QUALIFY quote_rank <= {limit}
)"""


def _crosstab(column: str, name: str) -> str:
    return f""",
counts AS (SELECT theme, {column} AS {name}, count(*) AS count FROM theme_rows GROUP BY theme, {column}),
crosstab AS (
  SELECT theme, {name}, count, {_pct('count', 'sum(count) OVER (PARTITION BY theme)')} AS share_within_theme_pct FROM counts
)"""


_THEME_ROWS = """,
theme_rows AS (
  SELECT review_id, unnest(themes) AS theme, sentiment_label, coalesce(airline, 'Unknown airline') AS airline,
    CASE WHEN recommended THEN 'yes' WHEN NOT recommended THEN 'no' ELSE 'unknown' END AS recommendation_label, rating
  FROM scored
)"""


def _pairs(rules: RuleSet) -> str:
    pains, focus = rules.ordered_pain_points(), rules.focus_pairs
    orders = ", ".join(f"({q(label)}, {i})" for i, label in enumerate(pains))
    listed = ", ".join(f"({q(a)}, {q(b)})" for a, b in focus)
    return f""",
pains(theme, place) AS (VALUES {orders}),
focus(theme_a, theme_b) AS (VALUES {listed}),
pained AS (SELECT doc_id, theme, place FROM (SELECT doc_id, unnest(themes) AS theme FROM coded) JOIN pains USING (theme)),
met AS (
  SELECT a.theme AS theme_a, b.theme AS theme_b, count(*) AS count
  FROM pained a JOIN pained b ON a.doc_id = b.doc_id AND a.place < b.place GROUP BY a.theme, b.theme
),
pairs AS (
  SELECT theme_a, theme_b, theme_a || ' + ' || theme_b AS combination_label, coalesce(met.count, 0) AS count,
    {_pct('coalesce(met.count, 0)', '(SELECT count(*) FROM coded)')} AS share_of_reviews_pct,
    (theme_a, theme_b) IN (SELECT (theme_a, theme_b) FROM focus) AS is_focus_combination
  FROM met FULL OUTER JOIN focus USING (theme_a, theme_b)
)"""


def _phrase_terms(rules: RuleSet) -> str:
    terms = _compact([f"CASE WHEN {_has(t)} THEN {q(t)} END" for t in rules.candidate_terms()])
    return f""",
negative AS (SELECT clean_text FROM scored WHERE sentiment_label = 'negative'),
terms AS (SELECT unnest({terms}) AS term FROM negative),
phrases AS (
  SELECT term, count(*) AS count, {_pct('count(*)', '(SELECT count(*) FROM negative)')} AS share_of_negative_reviews_pct,
    'seeded_phrase_count' AS source
  FROM terms GROUP BY term ORDER BY count DESC, term LIMIT 40
)"""


_BY_THEME = f""",
long AS (SELECT unnest(themes) AS theme, sentiment_label, sentiment_points FROM scored),
tallied AS (
  SELECT theme_list.theme, count(long.theme) AS review_count,
    round_even(avg(sentiment_points) / 100.0::DOUBLE, 2) AS avg_sentiment_score,
    count(*) FILTER (WHERE sentiment_label = 'negative') AS negative_count,
    count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral_count,
    count(*) FILTER (WHERE sentiment_label = 'positive') AS positive_count
  FROM theme_list LEFT JOIN long ON theme_list.theme = long.theme GROUP BY theme_list.theme
),
by_theme AS (
  SELECT *, {_pct('negative_count', 'review_count')} AS negative_share_pct,
    CASE WHEN review_count = 0 THEN NULL ELSE
      list_reverse_sort([(negative_count, 3, 'negative'), (neutral_count, 2, 'neutral'), (positive_count, 1, 'positive')])[1][3]
    END AS most_common_sentiment
  FROM tallied
)"""

_FREQUENCY = f""",
long AS (SELECT unnest(themes) AS theme, rating FROM coded),
frequency AS (
  SELECT theme_list.theme, description, count(long.theme) AS count,
    {_pct('count(long.theme)', '(SELECT count(*) FROM coded)')} AS share_of_reviews_pct,
    round_even(avg(rating), 2) AS avg_rating
  FROM theme_list LEFT JOIN long ON theme_list.theme = long.theme GROUP BY theme_list.theme, description
)"""

_STANDARD_DOCUMENTS = f"""
  SELECT 0 AS source_rank, {_review_id('document_reviews', 'airline', 'review_date', 'review_title', 'review_text')} AS review_id,
    'Document reviews' AS source, airline, cast(review_date AS VARCHAR) AS review_date, review_title, review_text, rating,
    {_flag('recommended')} AS recommended, {_disruption("lower(coalesce(" + _joined('review_title', 'review_text') + ", 'none'))")}
    AS disruption_type, {_joined('review_title', 'review_text')} AS raw_text, false AS is_synthetic,
    review_text AS feedback_text, doc_id, traveler_type, route, seat_type
  FROM raw"""


def _spelled() -> str:
    """The view with a date, a number and a flag that stand in the text in many spellings."""
    day = "date '2020-01-01' + cast(doc_id % 2500 AS INT)"
    return REVIEWS + f""",
spelled AS (
  SELECT * REPLACE (CASE WHEN doc_id % 10 = 7 THEN NULL ELSE {day} END AS review_date,
    CASE doc_id % 7 WHEN 0 THEN 7.0 WHEN 1 THEN 8.5 WHEN 2 THEN 10.0 WHEN 5 THEN -2.0 END::DOUBLE AS rating,
    CASE WHEN doc_id % 14 IN (0, 1, 2, 3, 4, 10) THEN true WHEN doc_id % 14 IN (5, 6, 7, 8, 9, 11) THEN false END AS recommended)
  FROM raw
)"""


def _full_id(key: str) -> str:
    parts = " || ' | ' || ".join(f"coalesce(cast({c} AS VARCHAR), 'nan')" for c in ("airline", "review_date", "review_title", "review_text"))
    return f"md5({q(key)} || ' | ' || {parts})"


_TERMS = """,
items AS (SELECT item_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM benchmark),
item_runs AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS term
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items, (SELECT unnest(range(1, 9)) AS n) WHERE len(w) >= n) WHERE term <> ''),
usable AS (SELECT doc_id, string_split(clean_text, ' ') AS w FROM prepared WHERE clean_text <> '' AND word_count >= 4),
all_runs AS (SELECT doc_id, array_to_string(w[i:i + n - 1], ' ') AS term
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM usable, (SELECT unnest(range(1, 9)) AS n) WHERE len(w) >= n)),
runs AS (SELECT DISTINCT doc_id, term FROM all_runs SEMI JOIN item_runs USING (term))"""


def build(rules: RuleSet = DEFAULT_RULES) -> dict[str, str]:
    coded, scored, themes = _coded(rules), _scored(rules), _theme_values(rules)
    by_theme = f"{scored}, {themes}{_BY_THEME}"
    frequency = f"{coded}, {themes}{_FREQUENCY}"
    pairs = coded + _pairs(rules)
    phrases = scored + _phrase_terms(rules)
    pain_points = _in(rules.pain_points)
    indicators = ", ".join(f"list_contains(themes, {q(t.label)})::INT AS {t.indicator}" for t in rules.themes)
    typed_columns = ("review_id, source, airline, review_date, review_title, review_text, rating, recommended, "
                     "disruption_type, raw_text, is_synthetic, feedback_text")
    recommendation = scored + _THEME_ROWS + _crosstab("recommendation_label", "recommendation")
    queries = {
        "standardize_reviews": f"{REVIEWS}, standardized AS ({_STANDARD_DOCUMENTS}) "
                               f"SELECT {typed_columns}, doc_id, traveler_type, route, seat_type FROM standardized",
        "review_ids": f"{REVIEWS}, standardized AS ({_STANDARD_DOCUMENTS}) SELECT doc_id, review_id FROM standardized",
        "union_sources": f"""{REVIEWS}, standardized AS ({_STANDARD_DOCUMENTS})
            SELECT source_rank, {typed_columns} FROM standardized
            UNION ALL SELECT 1, concat_ws('_', 'turn', conv_id, turn), 'Conversations', NULL, NULL, role, text, NULL, NULL,
              NULL, {_joined('role', 'text')}, true, text FROM conversations""",
        "airline_names": f"{REVIEWS} SELECT doc_id, {_airline('airline')} AS airline FROM raw",
        "disruption_types": f"""{STANDARD} SELECT doc_id, disruption_type AS inferred_type,
            {_label("' ' || upper(disruption_type) || chr(9)")} AS standardized_type FROM standard""",
        "spelled_fields": f"""{_spelled()} SELECT doc_id, 'raw_documents_' || substr({_full_id('raw_documents')}, 1, 12) AS review_id,
            cast(review_date AS VARCHAR) AS review_date, rating, recommended FROM spelled""",
        "spelled_dates": f"""{_spelled()} SELECT count(*) AS dated, count(*) FILTER (WHERE doc_id % 10 IN (0, 1, 6)) AS year_first,
            count(*) FILTER (WHERE doc_id % 10 = 3) AS compact, count(*) FILTER (WHERE doc_id % 10 IN (2, 8)) AS year_last,
            count(*) FILTER (WHERE doc_id % 10 IN (4, 9)) AS day_month_name, count(*) FILTER (WHERE doc_id % 10 = 5) AS month_name_day,
            count(*) FILTER (WHERE doc_id % 10 = 7) AS unread, count(*) FILTER (WHERE doc_id % 10 IN (2, 8) AND day(review_date) > 12) AS day_votes,
            0::BIGINT AS month_votes FROM spelled""",
        "safe_review_ids": f"""{REVIEWS}, full_ids AS (SELECT doc_id, {_full_id('document_reviews')} AS whole FROM raw)
            SELECT doc_id, 'document_reviews_' || CASE WHEN min(whole) OVER w <> max(whole) OVER w THEN whole ELSE left(whole, 3) END
              AS review_id FROM full_ids WINDOW w AS (PARTITION BY left(whole, 3))""",
        "text_fallback": f"{scored} SELECT doc_id, sentiment_score, sentiment_label FROM scored",
        "negative_fallback": f"""{scored}{_ngrams(DEFAULT_STOP_WORDS).replace('SELECT term, count(*) AS count FROM grams',
            'SELECT term, count(*) AS count, NULL::DOUBLE AS share_of_negative_reviews_pct, NULL::VARCHAR AS source FROM grams')}""",
        "dictionary_counts": f"{PREPARED}{_TERMS} SELECT term, count(*) AS count FROM runs GROUP BY term",
        "dictionary_themes": f"""{PREPARED}{_TERMS},
            themed AS (SELECT DISTINCT item_id % 40 AS place, term, md5(term) LIKE '0%' AS barred FROM item_runs WHERE n BETWEEN 2 AND 5),
            found AS (SELECT doc_id, place FROM runs JOIN themed USING (term) GROUP BY doc_id, place HAVING NOT bool_or(barred))
            SELECT doc_id, string_agg('topic ' || place, '; ' ORDER BY place) AS themes FROM found GROUP BY doc_id""",
        "dictionary_points": f"""{PREPARED}{_TERMS} SELECT doc_id,
            sum(strpos('0123456789abcdef', left(md5(term), 1)) - 9)::BIGINT AS points FROM runs GROUP BY doc_id""",
        "disruption_keywords": f"""{CLEANED} SELECT doc_id, disruption_keywords_found, len(keywords)::BIGINT AS keyword_count
            FROM cleaned""",
        "clean_reviews": f"""{CLEANED} SELECT doc_id, review_id, source, airline, review_date, review_month, review_title,
            review_text, rating, traveler_type, route, seat_type, recommended, is_synthetic, analysis_text,
            analysis_text AS feedback_text, clean_text, word_count, text_length, rating_bucket, disruption_type,
            disruption_keywords_found, likely_negative_experience FROM cleaned""",
        "review_order": f"""{CLEANED} SELECT doc_id, review_date, review_id FROM cleaned
            ORDER BY review_date NULLS LAST, review_id NULLS LAST""",
        "quality_counts": f"""{CLEANED} SELECT count(*) AS rows_before,
            count(*) FILTER (WHERE clean_text = '') AS empty_reviews_removed,
            count(*) FILTER (WHERE clean_text <> '' AND word_count < 4) AS short_reviews_removed,
            count(*) FILTER (WHERE word_count >= 4) - (SELECT count(*) FROM cleaned) AS duplicate_reviews_removed,
            (SELECT count(*) FROM cleaned) AS rows_after,
            (SELECT count(*) FROM cleaned) / count(*) AS retention_rate FROM prepared""",
        "missing_profile": f"""{CLEANED} SELECT 'review_text' AS field, count(*) FILTER (WHERE review_text = '') AS missing_count
            FROM cleaned UNION ALL SELECT 'rating', count(*) - count(rating) FROM cleaned
            UNION ALL SELECT 'traveler_type', count(*) - count(traveler_type) FROM cleaned
            UNION ALL SELECT 'route', count(*) - count(route) FROM cleaned
            UNION ALL SELECT 'seat_type', count(*) - count(seat_type) FROM cleaned""",
        "source_mix": f"""{CLEANED} SELECT CASE WHEN is_synthetic THEN 'synthetic' ELSE 'public' END AS origin,
            count(*) AS count FROM cleaned GROUP BY 1""",
        "theme_codes": f"""{coded} SELECT doc_id, array_to_string(themes, '; ') AS themes, len(themes)::INT AS theme_count,
            coalesce(themes[1], 'unclassified') AS primary_theme FROM coded""",
        "theme_evidence": f"{coded} SELECT doc_id, {_evidence(rules)} AS theme_evidence FROM coded",
        "theme_indicators": f"{coded} SELECT doc_id, {indicators} FROM coded",
        "theme_summary": f"{frequency} SELECT * FROM frequency ORDER BY count DESC, theme",
        "theme_coverage": f"""{coded} SELECT count(*) AS reviews_coded,
            count(*) FILTER (WHERE len(themes) > 0) AS reviews_with_theme,
            count(*) FILTER (WHERE len(themes) = 0) AS reviews_without_theme FROM coded""",
        "theme_quotes": f"{coded}{_quotes(3)} SELECT * FROM quotes",
        "sentiment_scores": f"{scored} SELECT doc_id, sentiment_score, sentiment_label FROM scored",
        "sentiment_evidence": _sentiment_evidence(rules),
        "sentiment_summary": f"""{scored} SELECT sentiment_label AS sentiment, count(*) AS count,
            round_even(avg(sentiment_points) / 100.0::DOUBLE, 2) AS avg_sentiment_score,
            {_pct('count(*)', '(SELECT count(*) FROM scored)')} AS share_of_reviews_pct FROM scored GROUP BY 1 ORDER BY 1""",
        "sentiment_by_theme": f"""{by_theme} SELECT * FROM by_theme
            ORDER BY negative_share_pct DESC, avg_sentiment_score NULLS LAST, review_count DESC""",
        "theme_frequency": f"""{frequency} SELECT theme, description, count, share_of_reviews_pct FROM frequency
            ORDER BY count DESC, theme""",
        "negative_phrases": f"{phrases} SELECT * FROM phrases",
        "negative_ngrams": scored + _ngrams(DEFAULT_STOP_WORDS),
        "negative_terms": f"{phrases} SELECT * FROM phrases",
        "rating_distribution": f"""{scored} SELECT rating, rating_bucket, count(*) AS count,
            {_pct('count(*)', '(SELECT count(rating) FROM scored)')} AS share_of_rated_reviews_pct
            FROM scored WHERE rating IS NOT NULL GROUP BY rating, rating_bucket ORDER BY rating""",
        "theme_rows": f"{scored}{_THEME_ROWS} SELECT * FROM theme_rows",
        "theme_vs_sentiment": f"{scored}{_THEME_ROWS}{_crosstab('sentiment_label', 'sentiment')} SELECT * FROM crosstab",
        "theme_vs_airline": f"{scored}{_THEME_ROWS}{_crosstab('airline', 'airline')} SELECT * FROM crosstab",
        "theme_vs_recommendation": f"{recommendation} SELECT * FROM crosstab",
        "pain_point_pairs": f"{pairs} SELECT * FROM pairs ORDER BY is_focus_combination DESC, count DESC, combination_label",
        "disruption_counts": f"""{CLEANED} SELECT coalesce(disruption_type, 'unknown') AS disruption_type, count(*) AS count
            FROM cleaned GROUP BY 1 ORDER BY count DESC, disruption_type LIMIT 8""",
        "top_pain_points": f"""{frequency} SELECT theme, description, count, share_of_reviews_pct FROM frequency
            WHERE theme IN {pain_points} ORDER BY count DESC, theme LIMIT 8""",
        "most_negative_themes": f"""{by_theme} SELECT * FROM by_theme WHERE review_count > 0
            ORDER BY negative_share_pct DESC, review_count DESC, theme LIMIT 8""",
        "highlighted_pairs": f"""{pairs} SELECT * FROM pairs
            ORDER BY is_focus_combination DESC, count DESC, combination_label LIMIT 8""",
        "corpus_kpis": f"""{CLEANED} SELECT count(*) AS total_reviews, count(DISTINCT airline) AS airlines_covered,
            count(*) FILTER (WHERE NOT is_synthetic) AS public_reviews,
            count(*) FILTER (WHERE is_synthetic) AS synthetic_reviews,
            round_even(avg(rating), 2) AS average_rating, round_even(median(rating), 2) AS median_rating,
            round_even(avg(recommended::INT) * 100, 2) AS recommended_share_pct,
            {_pct('count(*) FILTER (WHERE NOT is_synthetic)', 'count(*)')} AS public_share_pct,
            {_pct('count(*) FILTER (WHERE is_synthetic)', 'count(*)')} AS synthetic_share_pct FROM cleaned""",
        "rating_buckets": f"""{CLEANED} SELECT count(*) FILTER (WHERE rating <= 2) AS low_rated,
            count(*) FILTER (WHERE rating = 3) AS medium_rated,
            count(*) FILTER (WHERE rating > 2 AND rating <> 3) AS high_rated, count(rating) AS rated_total FROM cleaned""",
        "recommendation_pivot": f"""{recommendation}, {themes} SELECT t.theme,
            coalesce(max(share_within_theme_pct) FILTER (WHERE recommendation = 'yes'), 0.0::DOUBLE) AS yes_share_pct,
            coalesce(max(share_within_theme_pct) FILTER (WHERE recommendation = 'no'), 0.0::DOUBLE) AS no_share_pct
            FROM theme_list t LEFT JOIN crosstab ON crosstab.theme = t.theme
            GROUP BY t.theme""",
        "recovery_signals": f"""{by_theme} SELECT theme, review_count, positive_count,
            {_pct('positive_count', 'review_count')} AS positive_share_pct FROM by_theme WHERE review_count > 0""",
        "lead_quotes": f"""{coded}{_quotes(1)} SELECT theme, review_id, airline,
            CASE WHEN length(trim(quote_excerpt)) > 190
                 THEN regexp_replace(substr(trim(quote_excerpt), 1, 187), '\\s+$', '') || '...'
                 ELSE trim(quote_excerpt) END AS excerpt FROM quotes""",
        "headline_lists": f"""{by_theme}{_pairs(rules)}{_phrase_terms(rules)},
            themed AS (SELECT *, {_pct('review_count', '(SELECT count(*) FROM scored)')} AS share FROM by_theme)
            SELECT 'top_themes' AS list_name, row_number() OVER (ORDER BY review_count DESC, theme)::INT AS position,
              theme AS label, review_count AS count, share AS share_pct FROM themed QUALIFY position <= 5
            UNION ALL SELECT 'top_negative_themes', row_number() OVER (ORDER BY negative_share_pct DESC,
              avg_sentiment_score NULLS LAST, review_count DESC, theme)::INT AS position, theme, review_count,
              negative_share_pct FROM themed QUALIFY position <= 5
            UNION ALL SELECT 'top_negative_phrases', row_number() OVER (ORDER BY count DESC, term)::INT AS position, term,
              count, share_of_negative_reviews_pct FROM phrases QUALIFY position <= 10
            UNION ALL SELECT 'top_pairs', row_number() OVER (ORDER BY count DESC, combination_label)::INT AS position,
              combination_label, count, share_of_reviews_pct FROM pairs QUALIFY position <= 5
            UNION ALL SELECT 'leading_pairs', row_number() OVER (ORDER BY is_focus_combination DESC, count DESC,
              combination_label)::INT AS position, combination_label, count, share_of_reviews_pct FROM pairs
              QUALIFY position <= 5""",
    }
    return {name: "WITH " + sql.strip() for name, sql in queries.items()}
