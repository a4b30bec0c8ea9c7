"""Reading numbers aloud in Vietnamese, as column expressions (survey F1-F7, R6).

The words of 0 to 999 are a literal array, once as the leading group and once as an inner one; longer numbers are joined
from groups of three digits. Everything stays in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the language.
DIGITS = ["không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín"]
SCALES = ["", "nghìn", "triệu", "tỷ"]
LETTERS = {
    "A": "a", "B": "bê", "C": "xê", "D": "dê", "E": "e", "F": "ép", "G": "gờ", "H": "hát", "I": "i", "J": "gi", "K": "ca", "L": "lờ", "M": "mờ",
    "N": "nờ", "O": "o", "P": "pê", "Q": "quy", "R": "rờ", "S": "sờ", "T": "tê", "U": "u", "V": "vê", "W": "vê kép", "X": "ích", "Y": "i cờ rét", "Z": "dét",
}
ABBREVIATIONS = {"TP": "thành phố", "Q.": "quận", "P.": "phường", "H.": "huyện", "BV": "bệnh viện", "TTTM": "trung tâm thương mại", "QL": "quốc lộ", "TL": "tỉnh lộ"}
LONGEST_FIRST = sorted(ABBREVIATIONS, key=lambda a: (-len(a), a))

CARDINAL, DIGIT_BY_DIGIT, MIXED = "cardinal", "digit_by_digit", "mixed"


def below_hundred(n: int) -> str:
    """F2."""
    ten, one = divmod(n, 10)
    last = {1: "mốt" if ten > 1 else "một", 4: "tư" if ten > 1 else "bốn", 5: "lăm" if ten else "năm"}.get(one, DIGITS[one])
    head = ["", "mười"][ten] if ten < 2 else f"{DIGITS[ten]} mươi"
    return " ".join(w for w in (head, last if one or not ten else "") if w)


def below_thousand(n: int, leading: bool) -> str:
    """a group of three digits; an inner group always names its hundreds."""
    hundred, rest = divmod(n, 100)
    if leading and not hundred:
        return below_hundred(rest)
    words = [DIGITS[hundred], "trăm"]
    if rest:
        words += ["lẻ", DIGITS[rest]] if rest < 10 else [below_hundred(rest)]
    return " ".join(words)


def _table(leading: bool) -> Column:
    return F.split(F.lit("|".join(below_thousand(n, leading) for n in range(1000))), r"\|")  # folded to a constant once


def read_digits(s: Column) -> Column:
    """a string of digits, digit by digit; leading zeros are lost."""
    s = F.regexp_replace(s, "^0+(?=.)", "")
    words = F.split(F.lit("|".join(DIGITS)), r"\|")
    return F.array_join(F.transform(F.split(s, ""), lambda d: F.get(words, d.cast("int"))), " ")


def read_cardinal(s: Column) -> Column:
    """a string of digits as a cardinal number, of any length."""
    s = F.regexp_replace(s, "^0+(?=.)", "")
    n = F.ceil(F.length(s) / 3).cast("int")
    padded = F.lpad(s, n * 3, "0")
    lead, inner = _table(True), _table(False)

    def group(i: Column) -> Column:
        value = F.substring(padded, i * 3 + 1, F.lit(3)).cast("int")
        scale = n - i - 1
        names = F.split(F.lit("|".join(SCALES)), r"\|")
        name = F.when(scale < len(SCALES), F.get(names, scale)).otherwise(F.trim(F.repeat(F.lit(SCALES[-1] + " "), scale - 2)))
        word = F.when(i == 0, F.get(lead, value)).otherwise(F.get(inner, value))
        return F.when((value > 0) | (i == 0), F.trim(F.concat_ws(" ", word, name)))

    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), group), " ")


def read_number(s: Column, style: Column) -> Column:
    """F1 on a string of digits: mixed reads numbers below 100 as cardinals. Null for other styles and other strings."""
    ok = s.rlike("^[0-9]+$")
    cardinal = (style == CARDINAL) | ((style == MIXED) & (F.length(F.regexp_replace(s, "^0+(?=.)", "")) <= 2))
    return F.when(ok & cardinal, read_cardinal(s)).when(ok & style.isin(DIGIT_BY_DIGIT, MIXED), read_digits(s))


def _read_run(part: Column, style: Column) -> Column:
    """A part between slashes: its runs of digits and of letters."""
    letters = F.create_map(*[F.lit(x) for kv in LETTERS.items() for x in kv])

    def run(tok: Column) -> Column:
        small = (style == CARDINAL) | ((style == MIXED) & (F.length(tok) <= 2))
        spelled = F.array_join(F.transform(F.split(F.upper(tok), ""), lambda ch: F.try_element_at(letters, ch)), " ")
        return F.when(tok.rlike("^[0-9]"), F.when(small, read_cardinal(F.when(tok.rlike("^[0-9]"), tok).otherwise("0"))).otherwise(read_digits(F.when(tok.rlike("^[0-9]"), tok).otherwise("0")))).otherwise(spelled)

    return F.array_join(F.transform(F.regexp_extract_all(part, F.lit("([0-9]+|[A-Za-z]+)"), 1), run), " ")


def read_house_number(s: Column, style: Column) -> Column:
    """an abbreviation in front is expanded, parts between slashes are joined by "xuyệt"."""
    pattern = "^(" + "|".join(a.replace(".", r"\.") for a in LONGEST_FIRST) + ")"
    abbrev = F.regexp_extract(s, pattern, 1)
    names = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    rest = F.substring(s, F.length(abbrev) + 1, F.length(s))
    parts = F.filter(F.transform(F.split(rest, "/"), lambda p: _read_run(p, style)), lambda p: p != "")
    return F.trim(F.concat_ws(" ", F.try_element_at(names, abbrev), F.array_join(parts, " xuyệt ")))


def expand_abbreviations(c: Column) -> Column:
    """whole tokens only, longest first."""
    return reduce(lambda x, a: F.regexp_replace(x, r"(?U)(?<!\w)" + a.replace(".", r"\.") + r"(?!\w)", ABBREVIATIONS[a]), LONGEST_FIRST, c)


def verbalize_name(c: Column, style: Column) -> Column:
    """no digit is left."""
    tokens = F.split(expand_abbreviations(c), " ")
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), read_house_number(t, style)).otherwise(t)), " ")
