import hashlib
import random
import re

from voxtally.functions import text
from voxtally.rules import DEFAULT_RULES


def test_collapse_space_covers_unicode_space(evaluate):
    values = [None, "", "  a \n\t b ", "a b　c\x1cd", " x "]
    assert evaluate(text.collapse_space("x"), values) == ["", "", "a b", "a b c d", "x"]


def test_strip_keeps_inner_space(evaluate):
    assert evaluate(text.strip("x"), ["  a  b \n", "bag "]) == ["a  b", "bag"]


def test_normalize_words(evaluate):
    values = ["Don't STOP!", "  -- ", "Été 5h", "a b", "won’t|x_y"]
    assert evaluate(text.normalize_words("x"), values) == ["don t stop", "", "t 5h", "a b", "won t x y"]


def test_clean_words_equals_normalized_analysis_text(spark):
    alphabet = "aB1 .|-\n é"
    rng = random.Random(3)
    def some():
        return rng.choice([None, "".join(rng.choice(alphabet) for _ in range(rng.randrange(12)))])
    rows = [(some(), some()) for _ in range(500)]
    df = spark.createDataFrame(rows, "t string, b string").selectExpr(
        f"{text.clean_words('t', 'b')} AS direct",
        f"{text.normalize_words(text.analysis_text('t', 'b'))} AS via")
    assert df.where("direct <> via").count() == 0


def test_word_count_and_has_words_agree(evaluate):
    rng = random.Random(5)
    values = ["", "a", "...", "a b c d", "a b c", "İİ x", "K a b c"]
    values += ["".join(rng.choice("ab .\n-Zé") for _ in range(rng.randrange(14))) for _ in range(400)]
    words = text.clean_words("NULL", "x")
    counted = evaluate(text.word_count(words), values)
    assert counted == [len(w.split()) for w in evaluate(words, values)]
    for minimum in (1, 4):
        assert evaluate(text.has_words("NULL", "x", minimum), values) == [n >= minimum for n in counted]


def test_has_words_is_linear(evaluate):
    assert evaluate(text.has_words("NULL", "x", 4), ["a" * 300_000, "a " * 150_000]) == [False, True]


def test_parse_flag_takes_both_lists(evaluate):
    values = [None, " Yes ", "1.0", "Recommended", "NO", "0.0", "not recommended", "maybe", ""]
    assert evaluate(text.parse_flag("x"), values) == [None, True, True, True, False, False, False, None, None]


def test_parse_number_and_date_turn_bad_text_to_null(evaluate):
    assert evaluate(text.parse_number("x"), ["7", " 2.5 ", "1e1", "5d", "abc", "", None, "nan"]) == [
        7.0, 2.5, 10.0, None, None, None, None, None]
    parsed = evaluate(text.parse_date("x"), ["2015-08-09", "2015-02-30", "soon", None])
    assert [p and p.isoformat() for p in parsed] == ["2015-08-09", None, None, None]


def test_rating_bucket(evaluate):
    assert evaluate(text.rating_bucket("x"), [None, 1.0, 2.0, 2.5, 3.0, 3.5, 9.0], "double") == [
        "unknown", "low", "low", "high", "medium", "high", "high"]


def test_airline_label(evaluate):
    values = ["jetblue", "o'hare-shuttle", "el_al  israel", "air2you", None, " - ", "Air-India", "BRITISH-AIRWAYS"]
    assert evaluate(text.airline_label("x", DEFAULT_RULES), values) == [
        "JetBlue", "O'Hare Shuttle", "El Al Israel", "Air2You", "Unknown", "Unknown", "Air India", "British Airways"]


def test_disruption_is_substring_first_rule_wins(evaluate):
    values = ["We were happy", "a plate of food", "my bag", "my bag was", "Refund after cancellation", None, "nan", "fine",
              "no updates, long delay", "re-booked"]
    assert evaluate(text.infer_disruption("x", DEFAULT_RULES), values) == [
        "communication", "delay", "other", "baggage", "cancellation", "other", None, "other", "communication",
        "rebooking"]


def test_disruption_needles_left_out_change_nothing(evaluate):
    rng = random.Random(7)
    pieces = [n for _, ns in DEFAULT_RULES.disruption_rules for n in ns] + ["x", " ", "no ", "e"]
    values = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 3)))[rng.randrange(3):] for _ in range(400)]
    expected = [next((label for label, ns in DEFAULT_RULES.disruption_rules if any(n in v for n in ns)),
                     "other" if v else None) for v in values]
    assert evaluate(text.infer_disruption("x", DEFAULT_RULES), values) == expected


def test_disruption_label(evaluate):
    assert evaluate(text.disruption_label("x", DEFAULT_RULES), [" Delayed ", "CANCELLED", "Weather", "", None]) == [
        "delay", "cancellation", "weather", "unknown", "unknown"]


def test_review_id_reads_missing_as_nan(spark):
    df = spark.createDataFrame([("delta", "2015-01-02", None, "Été")], "a string, d string, t string, b string")
    found = df.selectExpr(f"{text.review_id('key', 'a', 'd', 't', 'b')} AS id").first().id
    assert found == "key_" + hashlib.md5("key | delta | 2015-01-02 | nan | Été".encode()).hexdigest()[:12]


def test_excerpt(evaluate):
    values = ["a" * 20, "a" * 21, "a" * 16 + "    tail"]
    assert evaluate(text.excerpt("x", 20), values) == ["a" * 20, "a" * 17 + "...", "a" * 16 + "..."]


def test_share_rounds_half_to_even(evaluate):
    # 1/800 = 0.125 %
    assert evaluate(text.share_pct("x", "800"), [1, 3, 0], "long") == [0.12, 0.38, 0.0]
    assert evaluate(text.share_pct("x", "0"), [0], "long") == [0.0]


def test_missing_spellings(evaluate):
    assert evaluate(text.missing_to_null("x"), ["NA", "None", "nan", "", "Nantes", None]) == [None] * 4 + ["Nantes", None]


def test_space_class_is_that_of_python(evaluate):
    chars = [chr(c) for c in [*range(1, 0x100), 0x1680, 0x180e, *range(0x2000, 0x2070), 0x3000, 0xfeff]]
    found = evaluate(f"rlike(x, {text.sql_string('^' + text.SPACE_CLASS + '$')})".replace("^(?U)", "(?U)^"), chars)
    assert found == [bool(re.fullmatch(r"\s", c)) for c in chars]
