"""Dictionaries as tables: matching against more terms than a plan should hold as literals.

The other operators carry a rule set's phrases inside the plan, which is right for some hundred.  Here a dictionary is a
table of terms with whatever belongs to them.  A text gives its runs of words that may be terms, each different run once;
the runs are joined to the terms, and what is found is grouped by the row it came from.

Before anything is shuffled the runs pass a *sieve*: maps of fixed size with a bit for the hash of each term and of each
beginning of one.  A run is made longer only where a term may go on, so the work per text follows the runs that terms begin
with and not the lengths that terms have.  What the sieve lets through is nearly only terms, so the join moves what is found
and not what a text consists of; when a dictionary outgrows the sieve, more passes and the join still decides.  The sieve
is computed from the dictionary inside the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtally.functions.literals import sql_let
from voxtally.functions.text import normalize_words
from voxtally.rules import RuleSet

#: Bits of each map of the sieve; as many beginnings as an eighth of it leave it nearly without false hits.
SIEVE_BITS = 1 << 22


def terms_table(df: DataFrame, term: str = "term") -> DataFrame:
    """A caller's dictionary with ``term`` in normalized form; terms without a word are left out, other columns stay."""
    others = [c for c in df.columns if c not in (term, "term")]
    words = F.expr(normalize_words(f"string({_quoted(term)})")).alias("term")
    return df.select(words, *[F.col(_quoted(c)) for c in others]).where("term <> ''")


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def longest_term(terms: DataFrame) -> Column:
    """The number of words of the longest term; null without terms."""
    return terms.agg(F.expr("max(size(split(term, ' ')))")).scalar()


def _holds(bits: str, hashed: str, size: int) -> str:
    """SQL: whether a map of ``size`` bits holds a hash.  Its highest bits say which bit of a number, the rest which number."""
    return f"getbit(get({bits}, int(pmod({hashed}, {size // 64}L))), int(shiftrightunsigned({hashed}, 58))) = 1"


def sieve(terms: DataFrame, bits: int = SIEVE_BITS) -> Column:
    """A bit for the hash of each term (``whole``), and of each run of words that a term begins with (``begun``).

    One value, two arrays of ``bits / 64`` numbers whatever the size of the dictionary.  The hash of a run takes in the hash
    of the run without its last word, and that word.
    """
    hashes = """aggregate(split(term, ' '), cast(array() AS array<bigint>), (done, word) ->
        array_append(done, IF(size(done) = 0, xxhash64(word), xxhash64(get(done, size(done) - 1), word))))"""
    runs = terms.selectExpr(f"{hashes} AS hashes").selectExpr("posexplode_outer(hashes) AS (i, h)", "size(hashes) AS n").where("h IS NOT NULL")
    set_bits = runs.selectExpr(f"pmod(h, {bits // 64}L) AS word", "shiftleft(1L, int(shiftrightunsigned(h, 58))) AS bit", "i", "n")
    set_bits = set_bits.selectExpr("word", "IF(i = n - 1, bit, 0L) AS whole", "bit AS begun")
    zeros = terms.sparkSession.range(bits // 64).selectExpr("id AS word", "0L AS whole", "0L AS begun")
    words = set_bits.unionAll(zeros).groupBy("word").agg(F.bit_or("whole").alias("whole"), F.bit_or("begun").alias("begun"))
    in_order = words.agg(F.expr("array_sort(collect_list(struct(word, whole, begun)))").alias("words"))
    return in_order.selectExpr("struct(words.whole AS whole, words.begun AS begun)").scalar()


def word_runs(texts: DataFrame, terms: DataFrame, key: Sequence[str], text: str = "clean_text", bits: int = SIEVE_BITS) -> DataFrame:
    """``key`` and each different run of words of normalized ``text`` that may be a term, as ``term``.

    Runs grow by a word at a time, from the places where a term may go on; only what may be a whole term becomes a string.
    """
    singles = f"filter(array_distinct(v.words), word -> {_holds('v.whole', 'xxhash64(word)', bits)})"
    begun = _holds("v.begun", "run.h", bits)
    first = f"filter(transform(v.words, (word, i) -> named_struct('i', i, 'h', xxhash64(word))), run -> {begun})"
    longer = f"""filter(transform(filter(acc.open, run -> run.i + n <= size(v.words)),
        run -> named_struct('i', run.i, 'h', xxhash64(run.h, get(v.words, run.i + n - 1)))), run -> {begun})"""
    whole = f"transform(filter(open, run -> {_holds('v.whole', 'run.h', bits)}), run -> array_join(slice(v.words, run.i + 1, n), ' '))"
    grown = f"transform(array({longer}), open -> named_struct('open', open, 'found', concat(acc.found, {whole})))[0]"
    several = f"""aggregate(IF(v.longest > 1, sequence(2, v.longest), cast(array() AS array<int>)),
        named_struct('open', {first}, 'found', cast(array() AS array<string>)),
        (acc, n) -> IF(size(acc.open) = 0, acc, {grown}), acc -> array_distinct(acc.found))"""
    known = texts.select(*key, F.col(text).alias("_text")).withColumns({"_longest": longest_term(terms), "_sieve": sieve(terms, bits)})
    maps = sql_let({"words": "v.words", "longest": "v.longest", "whole": "v.sieve.whole", "begun": "v.sieve.begun"}, f"concat({singles}, {several})")
    # an empty text has no words, as a null one; names used once are not written into the rows
    runs = sql_let({"words": "split(nullif(_text, ''), ' ')", "longest": "_longest", "sieve": "_sieve"}, maps)
    # outer: else the optimizer puts the size of the runs into a filter in front, and finds them twice
    return known.selectExpr(*key, f"{runs} AS _runs").selectExpr(*key, "explode_outer(_runs) AS term").where("term IS NOT NULL")


def term_hits(texts: DataFrame, terms: DataFrame, key: Sequence[str], text: str = "clean_text", bits: int = SIEVE_BITS) -> DataFrame:
    """Every dictionary entry whose term occurs in a row's normalized ``text``, once: ``key`` and the columns of ``terms``.

    How the join runs is left to the planner, which knows the dictionary's size; terms in very many texts are split as
    skewed keys.  Null and empty texts have no hits.  ``key`` identifies a row.
    """
    return word_runs(texts, terms, key, text, bits).join(terms, "term")


def document_counts(texts: DataFrame, terms: DataFrame, key: Sequence[str], text: str = "clean_text", bits: int = SIEVE_BITS) -> DataFrame:
    """``term`` and the number of rows that contain it, for terms that occur.

    Runs are counted before they meet the dictionary: a frequent term crosses the shuffle once for each task.
    """
    counted = word_runs(texts, terms, key, text, bits).groupBy("term").agg(F.expr("count(1)").alias("count"))
    return counted.join(terms.select("term").distinct(), "term")


def code_by_table(texts: DataFrame, rules: DataFrame, key: Sequence[str], text: str = "clean_text", bits: int = SIEVE_BITS) -> DataFrame:
    """``key`` and ``themes`` in the order of ``place``, for rows with a theme.

    ``rules`` has ``theme``, ``place``, ``term`` and ``kind``: a theme is assigned when a ``wanted`` term occurs and no
    ``barred`` one does.
    """
    hits = term_hits(texts, rules.select("theme", "place", "kind", "term").distinct(), key, text, bits)
    decided = hits.groupBy(*key, "theme", "place").agg(F.expr("max(kind = 'wanted')").alias("wanted"), F.expr("max(kind = 'barred')").alias("barred"))
    return decided.where("wanted AND NOT barred").groupBy(*key).agg(
        F.expr("transform(array_sort(collect_list(struct(place, theme))), t -> t.theme)").alias("themes"))


def points_by_table(texts: DataFrame, lexicon: DataFrame, key: Sequence[str], text: str = "clean_text", bits: int = SIEVE_BITS) -> DataFrame:
    """``key`` and ``points``, the weights (whole hundredths) of the different ``term`` of ``lexicon`` that occur, for rows with one."""
    return term_hits(texts, lexicon.select("term", "weight"), key, text, bits).groupBy(*key).agg(F.expr("sum(weight)").alias("points"))


def keywords_by_table(texts: DataFrame, keywords: DataFrame, key: Sequence[str], text: str = "clean_text", bits: int = SIEVE_BITS) -> DataFrame:
    """``key`` and the ``keywords`` that occur, in the order of ``place``, for rows with one."""
    hits = term_hits(texts, keywords.select("term", "place"), key, text, bits)
    return hits.groupBy(*key).agg(F.expr("transform(array_sort(collect_list(struct(place, term))), k -> k.term)").alias("keywords"))


def phrase_hits_by_table(texts: DataFrame, terms: DataFrame, key: Sequence[str], text: str = "clean_text", bits: int = SIEVE_BITS) -> DataFrame:
    """``key`` and ``phrase_hits``, the different terms that occur in no particular order, for rows with one."""
    hits = term_hits(texts, terms.select("term").distinct(), key, text, bits)
    return hits.groupBy(*key).agg(F.expr("collect_list(term)").alias("phrase_hits"))


# --- a rule set as tables ----------------------------------------------------------------------------------------------


def phrase_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    return spark.createDataFrame([(p,) for p in rules.all_phrases()], "term string")


def theme_terms(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """Phrases of all themes for :func:`code_by_table`; regular expressions have no place in a table of terms."""
    rows = [(t.label, i, kind, p) for i, t in enumerate(rules.themes) for kind, phrases in (("wanted", t.phrases), ("barred", t.suppressed_by)) for p in phrases]
    return spark.createDataFrame(rows, "theme string, place int, kind string, term string")


def lexicon_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    return spark.createDataFrame([(p, round(w * 100)) for p, w in rules.lexicon.phrase_weights.items()], "term string, weight int")


def keyword_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    return spark.createDataFrame([(k, i) for i, k in enumerate(rules.disruption_keywords)], "term string, place int")
