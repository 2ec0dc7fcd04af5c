"""Text and value normalization as SQL expressions.

Every function takes SQL expressions, usually column names, and returns one:
use the result with ``selectExpr`` or ``F.expr``.  All of it is built-in
functions, so it runs inside the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtally import dictionaries as d
from voxtally.functions.literals import sql_array, sql_let, sql_map, sql_string
from voxtally.rules import RuleSet

# Unicode white space.  The default class of the regex engine is ASCII only,
# and trim() without an argument strips nothing but blanks.
SPACE_CLASS = r"(?U)[\s\x1c-\x1f]"
SPACE_CHARS = "".join(map(chr, [*range(9, 14), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                                0x2028, 0x2029, 0x202f, 0x205f, 0x3000]))
_LETTER = r"\p{L}"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def with_exprs(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Add or replace columns, all computed from the columns as they were."""
    return df.withColumns({name: F.expr(e) for name, e in expressions.items()})


def aliased(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(e).alias(name) for name, e in expressions.items()]


def collapse_space(text: str) -> str:
    """Null becomes empty, white-space runs become one blank, ends are trimmed."""
    return f"trim(regexp_replace(coalesce({text}, ''), {sql_string(SPACE_CLASS + '+')}, ' '))"


def empty_to_null(text: str) -> str:
    return f"nullif({text}, '')"


def strip(text: str) -> str:
    return f"trim(BOTH {sql_string(SPACE_CHARS)} FROM {text})"


def join_parts(title: str, body: str) -> str:
    """The parts that are not empty, joined by `` | ``."""
    return f"concat_ws(' | ', {empty_to_null(title)}, {empty_to_null(body)})"


def combine_parts(title: str, body: str) -> str:
    """Title and body as found, trimmed, joined by `` | ``; null when both are blank."""
    return empty_to_null(join_parts(strip(title), strip(body)))


def analysis_text(title: str, body: str) -> str:
    """Title and body with collapsed white space, joined by `` | ``."""
    return join_parts(collapse_space(title), collapse_space(body))


def normalize_words(text: str) -> str:
    """Lower-case words of ``a-z0-9`` separated by single blanks.

    One pass is enough: white space is outside ``a-z0-9`` too, so every run of
    other characters collapses into a single blank.
    """
    return f"trim(regexp_replace(lower({text}), '[^a-z0-9]+', ' '))"


def clean_words(title: str, body: str) -> str:
    """Normalized words of title and body, without building the analysis text first."""
    return normalize_words(f"concat_ws(' ', {title}, {body})")


def word_count(words: str) -> str:
    """Number of words in normalized text, from its blanks."""
    return f"IF({words} = '', 0, length({words}) - length(replace({words}, ' ', '')) + 1)"


def has_words(title: str, body: str, minimum: int) -> str:
    """Whether the normalized text would hold at least ``minimum`` words.

    Looks at the raw text only as far as needed: nearly every review has its
    first words at the start, and only the others are lower-cased and searched
    as a whole.  Written with possessive quantifiers and an anchor, so it is
    linear on any input.  As a filter it sits on the scan; filtering on
    ``word_count`` instead would make the optimizer repeat the whole
    normalization inside the filter.
    """
    pattern = sql_string(r"\A[^a-z0-9]*+(?:[a-z0-9]++[^a-z0-9]++){%d}[a-z0-9]" % max(minimum - 1, 0))
    tests = [f"rlike(lower(concat_ws(' ', {title}, {part})), {pattern})" for part in (f"left({body}, 200)", body)]
    return f"({tests[0]} OR {tests[1]})"


def parse_flag(value: str) -> str:
    """Yes/no spellings to boolean; anything else is null."""
    word = f"lower({strip(f'string({value})')})"
    return (f"CASE WHEN array_contains({sql_array(d.TRUE_WORDS)}, {word}) THEN true "
            f"WHEN array_contains({sql_array(d.FALSE_WORDS)}, {word}) THEN false END")


def flag_label(flag: str) -> str:
    return f"CASE WHEN {flag} THEN 'yes' WHEN NOT {flag} THEN 'no' ELSE 'unknown' END"


def parse_number(value: str) -> str:
    """Text to double; text that is not a plain number is null."""
    text = strip(f"string({value})")
    return f"try_cast(IF(rlike({text}, {sql_string(_NUMBER)}), {text}, NULL) AS double)"


def parse_date(value: str) -> str:
    return f"try_cast({strip(f'string({value})')} AS date)"


def rating_bucket(rating: str, low: float = 2, medium: float = 3) -> str:
    """``low`` up to and including ``low``, ``medium`` only at exactly ``medium``, else ``high``."""
    return (f"CASE WHEN {rating} IS NULL THEN 'unknown' WHEN {rating} <= {low} THEN 'low' "
            f"WHEN {rating} = {medium} THEN 'medium' ELSE 'high' END")


def airline_label(name: str, rules: RuleSet) -> str:
    """Slug or mixed-case airline name to a readable label."""
    words = collapse_space(f"translate(lower({collapse_space(name)}), '_-', '  ')")
    return sql_let({"name": words}, f"""CASE WHEN v.name = '' THEN 'Unknown'
        ELSE coalesce(try_element_at({sql_map(rules.airline_names)}, v.name), {title_case('v.name')}) END""")


def title_case(text: str) -> str:
    """Upper-case the first letter of every run of letters in lower-case text."""
    runs = f"regexp_extract_all({text}, {sql_string('[^' + _LETTER + ']+|' + _LETTER + '+')}, 0)"
    return f"array_join(transform({runs}, run -> concat(upper(substr(run, 1, 1)), substr(run, 2))), '')"


def infer_disruption(raw_text: str, rules: RuleSet) -> str:
    """First disruption rule with a substring in the text, else ``other``.

    A missing text counts as a text without matches; the text ``nan`` is null.
    """
    branches = ["WHEN v.text IN ('', 'nan') THEN NULL"]
    for label, needles in rules.disruption_rules:
        # a needle that contains another needle of its rule cannot add a match
        needed = [n for n in needles if not any(o != n and o in n for o in needles)]
        test = " OR ".join(f"contains(v.text, {sql_string(n)})" for n in needed)
        branches.append(f"WHEN {test} THEN {sql_string(label)}")
    return sql_let({"text": f"lower(coalesce({raw_text}, 'none'))"}, f"CASE {' '.join(branches)} ELSE 'other' END")


def disruption_label(value: str, rules: RuleSet) -> str:
    """Related labels to one; unmapped text passes in lower case, blank is ``unknown``."""
    mapped = f"try_element_at({sql_map(rules.disruption_labels)}, v.label)"
    return sql_let({"label": f"lower({collapse_space(value)})"}, f"coalesce({mapped}, nullif(v.label, ''), 'unknown')")


def review_id(dataset_key: str, airline: str, date_text: str, title: str, body: str, length: int = 12) -> str:
    """Stable identifier from the review's own fields, missing ones read as ``nan``.

    The default 12 hex digits (48 bits) will meet collisions from about ten
    million reviews on; ask for up to 32 digits, and never join on it alone.
    """
    parts = ", ".join(f"coalesce(string({part}), 'nan')" for part in (airline, date_text, title, body))
    seed = f"concat_ws(' | ', {sql_string(dataset_key)}, {parts})"
    return f"concat({sql_string(dataset_key + '_')}, substr(md5({seed}), 1, {length}))"


def excerpt(text: str, limit: int) -> str:
    """At most ``limit`` characters, ending in ``...`` when shortened."""
    head = f"trim(TRAILING {sql_string(SPACE_CHARS)} FROM substr({text}, 1, {limit - 3}))"
    return f"IF(length({text}) > {limit}, concat({head}, '...'), {text})"


def share_pct(part: str, whole: str) -> str:
    """Percentage with two decimals, ties to even; 0 when there is nothing to share."""
    return f"IF({whole} = 0, 0D, bround({part} / {whole} * 100, 2))"


def missing_to_null(text: str) -> str:
    """Spellings of "missing" in CSV files to null."""
    return f"IF(array_contains({sql_array([*d.CSV_MISSING, ''])}, {text}), NULL, {text})"
