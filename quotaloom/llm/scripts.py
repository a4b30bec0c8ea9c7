"""Visually identical text with different characters, brought to one form (problem 4).

Per token the resolved script sets of its letters are intersected (script extensions; Han also stands for Japanese and Korean;
common and inherited characters fit any script; the home alphabet, Vietnamese with f, j, w, z, is a script of its own). An empty
intersection is a mixed token: its consistent script is one in which every letter is or has a confusable form, the column's
dominant script if it is one, else that with the fewest letters replaced. So a Cyrillic name with a Latin o becomes Cyrillic again. If no script fits
all letters, those with a form in the dominant script take it. A token wholly of one other script whose letters all have a form in
the dominant script is a whole-script confusable; it keeps its letters in ``folded``, since it may be an honest name, and takes the
dominant script's in ``compared``. Then come the remaining forms: composition (NFC), full-width forms, invisible characters, and
spaces other than U+0020.

Confusable letters come from Unicode's public data in the ICU library that Spark itself brings: letters with one skeleton look alike.

A value is a case if it has one of: an accent not in composed form, an invisible character, a space other than U+0020, a
full-width Latin letter, digit or sign, or is a mixed token with letters of the home alphabet. Words wholly
in another script are left alone with their punctuation: joiners between letters of scripts that need them, and full-width
signs whose neighbouring letters are East Asian.

Rows whose value has only plain characters are decided by one regular expression on the JVM side; only the others reach
Python, in Arrow batches, and there each distinct value once.

Cases: null and empty values are no case and stay as they are; a value of blanks only stays. Repeated rows with one key come
out once. Folding is idempotent.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TONES = "̣̀̉̃́"


def home_alphabet() -> frozenset[str]:
    """The Vietnamese letters with f, j, w, z, in both cases, composed."""
    letters = set("abcdefghijklmnopqrstuvwxyz" + "đ")
    for v in "aăâeêioôơuưy":
        letters |= {v} | {unicodedata.normalize("NFC", v + t) for t in TONES}
    return frozenset(letters | {c.upper() for c in letters})


HOME = home_alphabet()

HOME_SCRIPT = "Viet"

INVISIBLE = regex.compile(r"[\p{Cf}͏ᅟᅠ឴឵᠋-᠏⁥ㅤ︀-️ﾠ\U000E0000-\U000E0FFF]")
JOINERS = "‌‍"
#: Scripts whose spelling needs joiners or direction marks.
JOINING = frozenset("Arab Syrc Mong Nkoo Deva Beng Guru Gujr Orya Taml Telu Knda Mlym Sinh Khmr Mymr Tibt".split())
EAST_ASIAN = frozenset("Hani Hira Kana Hang Bopo Yiii".split())
SCRIPTS = "Latn Cyrl Grek Armn Geor Hebr Arab Syrc Thaa Deva Beng Guru Gujr Orya Taml Telu Knda Mlym Sinh Thai Laoo Tibt Mymr Hang Ethi Cher Khmr Mong Hira Kana Bopo Hani Yiii Copt Goth Nkoo Tfng Lisu Vaii".split()
_SCRIPT = {s: regex.compile(rf"\p{{scx={s}}}") for s in SCRIPTS}
_COMMON = regex.compile(r"[\p{sc=Zyyy}\p{sc=Zinh}]")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_SPACE = regex.compile(r"[^\S ]|(?! )\p{Zs}")
_WIDE = regex.compile(r"[！-～￠-￦]")
_WIDE_WORD = regex.compile(r"[０-９Ａ-Ｚａ-ｚ]")
_LETTER = regex.compile(r"\p{L}")
_IDEOGRAPH = regex.compile(r"[\p{Han}\p{Hangul}]")

#: JVM-side: a value of these characters only is no case. Fixed ranges: printable ASCII, the alphabet, usual signs. Not $, which in
#: Java also stands before a last line end.
PLAIN = r"^[\x20-\x7E" + "".join(sorted(c for c in HOME if ord(c) > 127)) + r"–—‘’“”…·°²³½]*(?![\s\S])"


@lru_cache(maxsize=1 << 16)
def script_set(ch: str) -> frozenset[str] | None:
    """Resolved scripts of a character; None if it fits any script."""
    if ch in HOME:
        return frozenset([HOME_SCRIPT])
    found = {s for s, r in _SCRIPT.items() if r.match(ch)}
    if not found:
        return None if _COMMON.match(ch) else frozenset([unicodedata.name(ch, "?").split()[0]])
    if found & {"Hani"}:
        found |= {"Jpan", "Kore", "Hanb"}
    if found & {"Hira", "Kana"}:
        found |= {"Jpan"}
    if "Hang" in found:
        found |= {"Kore"}
    if "Bopo" in found:
        found |= {"Hanb"}
    return frozenset(found)


def token_scripts(token: str) -> frozenset[str] | None:
    """Intersection of the script sets; None: any script; empty: mixed."""
    out: frozenset[str] | None = None
    for ch in token:
        s = script_set(ch)
        if s is not None:
            out = s if out is None else out & s
    return out


def skeletons(spark: SparkSession) -> dict[str, str]:
    """The skeleton of every letter of an alphabet, by the ICU library in Spark's own class path; one call for all."""
    letters = [c for c in map(chr, range(0x20000)) if _LETTER.match(c) and not _IDEOGRAPH.match(c)]
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    found = dict(zip(letters, checker.getSkeleton("\n".join(letters)).split("\n")))
    several = Counter(found.values())
    return {c: s for c, s in found.items() if several[s] > 1}


class Confusables:
    """The forms of a letter in other scripts: letters of the same skeleton and case, the lowest code point of several."""

    def __init__(self, skeleton: dict[str, str]) -> None:
        self.skeleton = skeleton
        self.forms: dict[tuple[str, str, str], str] = {}
        for c, s in sorted(skeleton.items(), reverse=True):
            for script in script_set(c) or () if unicodedata.normalize("NFKC", c) == c else ():
                self.forms[s, script, unicodedata.category(c)] = c
        self.seen: dict[tuple[str, str], str | None] = {}

    def form(self, ch: str, script: str) -> str | None:
        """``ch`` in ``script``: itself, a look-alike with the accents that stand on it, or for the home script its compatible form."""
        key = (ch, script)
        if key not in self.seen:
            self.seen[key] = self._form(ch, script)
        return self.seen[key]

    def _form(self, ch: str, script: str) -> str | None:
        scripts = script_set(ch)
        if scripts is None or script in scripts:
            return ch
        base, *marks = unicodedata.normalize("NFD", ch)
        for c, accents in ((ch, []), (base, marks)):
            to = self.forms.get((self.skeleton.get(c, ""), script, unicodedata.category(c)))
            if to is not None:
                out = unicodedata.normalize("NFC", to + "".join(accents))
                if script != HOME_SCRIPT or all(x in HOME for x in out if _LETTER.match(x)):
                    return out
        compat = unicodedata.normalize("NFKC", ch)
        return compat if script == HOME_SCRIPT and all(c in HOME for c in compat) else None


def consistent_spelling(token: str, table: Confusables, dominant: str = HOME_SCRIPT) -> tuple[str, str]:
    """(spelling, kind): kind is ``plain`` (letters of one script), ``whole`` (of one other script, all with a form in the dominant
    one), ``mixed`` or ``case`` (mixed, with letters of the home alphabet)."""
    letters = [c for c in token if _LETTER.match(c)]
    common = token_scripts("".join(letters))
    if common is None or common:
        other = common is not None and dominant not in common
        return token, "whole" if other and all(table.form(c, dominant) for c in letters) else "plain"
    scripts = [script_set(c) for c in letters]
    fits = []
    for script in sorted(set().union(*(s for s in scripts if s)) - {"Latn"}):  # Latin beside the home alphabet is no spelling
        if all(table.form(c, script) for c in letters):
            fits.append((script != dominant, sum(s is not None and script not in s for s in scripts), script))
    chosen = min(fits)[2] if fits else dominant
    spelling = "".join((table.form(c, chosen) or c) if _LETTER.match(c) else c for c in token)
    return spelling, "case" if any(s is not None and HOME_SCRIPT in s for s in scripts) else "mixed"


def _near(text: str, i: int) -> list[frozenset[str]]:
    """Script sets of the nearest letters before and after place ``i``."""
    out = []
    for step in (-1, 1):
        k = i + step
        while 0 <= k < len(text):
            if _LETTER.match(text[k]):
                out.append(script_set(text[k]) or frozenset())
                break
            k += step
    return out


def _own_punctuation(text: str, i: int) -> bool:
    """Whether the character belongs to a word of another script."""
    near = _near(text, i)
    if text[i] in JOINERS:
        return bool(near) and all(s & JOINING for s in near)
    return bool(near) and not _WIDE_WORD.match(text[i]) and all(s & EAST_ASIAN for s in near)


def fold(value: str, table: Confusables, dominant: str = HOME_SCRIPT) -> tuple[str, bool, bool, str]:
    """(one plain form, whether the value is a case, whether it has whole-script confusables, the form with these replaced)."""
    text = unicodedata.normalize("NFC", value)
    case = text != value
    out = []
    for i, ch in enumerate(text):
        if ord(ch) < 127 and ch >= " ":
            out.append(ch)
        elif _SPACE.match(ch):
            case = True
            out.append(" ")
        elif INVISIBLE.match(ch):
            if ch in JOINERS and _own_punctuation(text, i):
                out.append(ch)
            else:
                case = True
        elif _WIDE.match(ch) and not _own_punctuation(text, i):
            case = True
            out.append(unicodedata.normalize("NFKC", ch))
        else:
            out.append(ch)
    text = unicodedata.normalize("NFC", "".join(out))
    plain, compared, at, whole = [], [], 0, False
    for m in _WORD.finditer(text):
        spelling, kind = consistent_spelling(m.group(), table, dominant)
        case |= kind == "case"
        whole |= kind == "whole"
        between = text[at : m.start()]
        plain += [between, spelling]
        compared += [between, "".join((table.form(c, dominant) or c) if _LETTER.match(c) else c for c in spelling) if kind == "whole" else spelling]
        at = m.end()
    plain, compared = (unicodedata.normalize("NFC", "".join([*x, text[at:]])) for x in (plain, compared))
    return plain, case, whole, compared


def dominant_scripts(df: DataFrame, fields: list[str]) -> dict[str, str]:
    """The script in which most values of each field have letters, the home script if none has more; one pass."""
    home = f"[{''.join(sorted(HOME))}]"
    tests = {HOME_SCRIPT: home, "Cyrl": r"\p{IsCyrillic}", "Grek": r"\p{IsGreek}", "Armn": r"\p{IsArmenian}"}
    row = df.agg(*[F.count_if(F.col(f).cast("string").rlike(r)).alias(f"{k}_{s}") for k, f in enumerate(fields) for s, r in tests.items()]).first()
    return {f: max(tests, key=lambda s: (row[f"{k}_{s}"] or 0, s == HOME_SCRIPT)) for k, f in enumerate(fields)}


def folded(df: DataFrame, *, key: str, fields: list[str], table_name: str, dominant: dict[str, str] | None = None) -> DataFrame:
    """(table_name, row_key, field, value, folded, compared, is_case, whole_script) of every non-null value that isn't plain.

    ``dominant`` names the dominant script of fields where it isn't the home script.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    rows = df.select(F.col(key).cast("string").alias("row_key"), F.explode(pairs).alias("_p")).select("row_key", "_p.field", "_p.value")
    rows = rows.filter(F.col("value").isNotNull() & ~F.col("value").rlike(PLAIN)).distinct()
    shared, script = df.sparkSession.sparkContext.broadcast(skeletons(df.sparkSession)), dict(dominant or {})  # some 7,000 letters
    names = ["row_key", "field", "value", "folded", "is_case", "whole_script", "compared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Confusables(shared.value)
        for b in batches:
            enc = b.column(2).dictionary_encode()
            per_script = {s: [fold(v, table, s) for v in enc.dictionary.to_pylist()] for s in {HOME_SCRIPT, *script.values()}}
            at, own = enc.indices.to_pylist(), [script.get(f, HOME_SCRIPT) for f in b.column(1).to_pylist()]
            res = [per_script[s][k] for s, k in zip(own, at)]
            cols = [pa.array([r[j] for r in res], t) for j, t in enumerate((pa.string(), pa.bool_(), pa.bool_(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *cols], names=names)

    out = rows.mapInArrow(run, "row_key string, field string, value string, folded string, is_case boolean, whole_script boolean, compared string")
    return out.select(F.lit(table_name).alias("table_name"), "row_key", "field", "value", "folded", "compared", "is_case", "whole_script")
