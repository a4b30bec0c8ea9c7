"""Scalar functions on fixed cases."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quotaloom.functions import draws, names, numbers, templates
from quotaloom.plans import text


def values(spark, cases, f, kind="string"):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, " + ", ".join(f"c{k} {kind}" for k in range(len(cases[0]))))
    return [r[0] for r in df.orderBy("i").select(f(*[F.col(f"c{k}") for k in range(len(cases[0]))]).alias("v")).collect()]


def test_cardinals(spark):
    cases = {
        "0": "không", "1": "một", "5": "năm", "10": "mười", "11": "mười một", "15": "mười lăm", "20": "hai mươi", "21": "hai mươi mốt", "24": "hai mươi tư", "25": "hai mươi lăm", "100": "một trăm",
        "101": "một trăm lẻ một", "105": "một trăm lẻ năm", "110": "một trăm mười", "111": "một trăm mười một", "115": "một trăm mười lăm", "121": "một trăm hai mươi mốt", "1000": "một nghìn",
        "1234": "một nghìn hai trăm ba mươi tư", "1005": "một nghìn không trăm lẻ năm", "1000000": "một triệu", "007": "bảy",
    }
    assert values(spark, [(k,) for k in cases], numbers.read_cardinal) == list(cases.values())


def test_long_numbers_have_a_word_for_every_group(spark):
    assert values(spark, [("1000000000000",)], numbers.read_cardinal) == ["một tỷ tỷ"]


def test_styles(spark):
    got = values(spark, [("15", "mixed"), ("115", "mixed"), ("115", "digit_by_digit"), ("x", "cardinal"), ("5", "none")], numbers.read_number)
    assert got == ["mười lăm", "một một năm", "một một năm", None, None]


@pytest.mark.parametrize(
    ("text", "style", "want"),
    [("15B", "cardinal", "mười lăm bê"), ("12/3", "cardinal", "mười hai xuyệt ba"), ("553/18/55", "mixed", "năm năm ba xuyệt mười tám xuyệt năm mươi lăm"), ("QL1A", "cardinal", "quốc lộ một a"), ("107", "digit_by_digit", "một không bảy")],
)
def test_house_numbers(spark, text, style, want):
    assert values(spark, [(text, style)], numbers.read_house_number) == [want]


def test_abbreviations(spark):
    assert values(spark, [("TP Q. TTTM",), ("HTPX BVA",), ("ra BV, TL",)], numbers.expand_abbreviations) == ["thành phố quận trung tâm thương mại", "HTPX BVA", "ra bệnh viện, tỉnh lộ"]


def test_clean_name(spark):
    cases = {
        "Sea Castle\nHotel": "Sea Castle", "A;B": "A", "Sea Castle Sea Castle": "Sea Castle", "Nhậu Nhậu Nhậu": "Nhậu", "A & B": "A và B", "Tp.Huế": "Thành phố Huế", "Quán (cơ sở hai)": "Quán cơ sở hai",
        "Văn – Quốc": "Văn Quốc", "a_b|c": "a b c", "Cho\u031b\u0323": "Chợ", "": "",
    }
    composed = values(spark, [(k,) for k in cases], names.nfc)
    got = values(spark, [(k,) for k in composed], names.clean_name)
    assert got == list(cases.values())
    assert values(spark, [(v,) for v in got], names.clean_name) == got


def test_usable_and_speakable(spark):
    assert values(spark, [("Công viên",), ("MX",), ("ACB",), ("Khach San Misa",), ("WinMart",), ("Hồ Tây",), (" ",)], names.is_usable) == [False, False, True, False, True, True, False]
    assert values(spark, [("Hồ Tây",), ("Café 24",), ("東京",), ("서울",), ("Мост",), (" ",)], names.is_speakable) == [True, True, False, False, False, False]


def test_keys(spark):
    assert values(spark, [("Đường Nguyễn",)], names.fold_search) == ["duong nguyen"]
    assert values(spark, [("Đà Nẵng",), ("!!",)], names.slug) == ["da_nang", "unnamed"]
    assert values(spark, [("Cho,  hỏi!",)], names.exact_key) == ["cho hỏi"]
    assert values(spark, [("đường 21",), ("Hẻm Ba",), ("Chợ",)], lambda c: F.concat_ws("|", *names.street_prefix(c))) == ["Đường|21", "Hẻm|Ba", "Chợ"]


ODD_NAMES = [
    "Кến", "ｎｇõ Ｍảｎ", "phố​ A", "東京", "Müller Straße", "Мост", "số １２", "A東 B", "Cho\u031b\u0323 \u0110o\u0302ng", "½ km", "İzmir", "\u00ad", "", "Đà Nẵng",
    "Ngo\u0303 12", "ĐƯỜNG １２ Hẻm Phố", "Đường", "đường\n", "Hẻm 5\nTổ Đường", "Pho\u0302\u0301 Kie\u0323\u0302t", "Кiệt 3", "７ Phố", "Đường  9", "Ｎｇõ 3", "Kıệt Hện Phố", "Ngõ", "đường 21",
]


def odd_names_table(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/generate_small.parquet").slice(0, len(ODD_NAMES))
    new = {"id": [f"r{k:02d}" for k in range(len(ODD_NAMES))], "entity_id": [f"e{k:02d}" for k in range(len(ODD_NAMES))], "entity": ODD_NAMES, "street": ODD_NAMES, "category": ["address", None, "street"] * 9, "subcategory": ["ngõ hẹp", None, "đường lớn"] * 9}
    for c, v in new.items():
        t = t.set_column(t.schema.get_field_index(c), c, pa.array(v, t.schema.field(c).type))
    pq.write_table(t, tmp_path / "generate_small.parquet")
    return str(tmp_path)


def test_slugs_of_all_names(spark, tmp_path):
    got = {r.entity_id: (r.slug, r.ref) for r in text.slug_and_ref_ids(spark, odd_names_table(tmp_path)).collect()}
    province = {r.entity_id: r.province or "" for r in spark.read.parquet(f"{tmp_path}/generate_small.parquet").collect()}
    for k, name in enumerate(ODD_NAMES):
        plain = unicodedata.normalize("NFKD", name.translate(str.maketrans("đĐ", "dD"))).encode("ascii", "ignore").decode().lower()
        slug = re.sub("[^a-z0-9]+", "_", plain).strip("_") or "unnamed"
        assert got.pop(e := f"e{k:02d}") == (slug, f"manual_{province[e]}_{slug}"), name
    assert not got


def test_prefixes_of_all_streets(spark, tmp_path):
    got = {r.id: tuple(r) for r in text.prefix_split_and_case(spark, odd_names_table(tmp_path)).collect()}
    known = {w.casefold(): w for w in names.STREET_WORDS}
    for k, name in enumerate(ODD_NAMES):
        name, category, kind = unicodedata.normalize("NFC", name), ["address", None, "street"][k % 3], ["ngõ hẹp", None, "đường lớn"][k % 3] or ""
        head, _, rest = name.partition(" ")
        prefix = known.get(head.casefold(), "")
        rest = rest if prefix else name
        lowered = " ".join(w.lower() if w in known.values() else w for w in name.split(" "))
        want = (prefix, rest, head.casefold() == kind.split(" ")[0].casefold(), lowered, category == "address" or rest[:1].isdigit())
        assert got.pop(i := f"r{k:02d}") == (i, *want), name
    assert not got


def test_substitute_squeezes(spark):
    got = values(spark, [("{opener}tới {entity}{closer}", "", "X", "nhé"), ("{opener}tới {entity}{closer}", "này", "X", "")], lambda t, o, e, c: templates.substitute(t, opener=o, entity=e, closer=c))
    assert got == ["tới X nhé", "này tới X"]


def test_draws_are_uniform_and_stable(spark):
    df = spark.range(4000).select(draws.uniform("7", F.col("id").cast("string"), "axis").alias("u"), draws.weighted_pick([("a", 3.0), ("b", 1.0)], draws.uniform("7", F.col("id").cast("string"), "pick")).alias("p"))
    mean, low, high, a = df.agg(F.avg("u"), F.min("u"), F.max("u"), F.avg((F.col("p") == "a").cast("int"))).first()
    assert abs(mean - 0.5) < 0.02 and 0 <= low and high < 1 and abs(a - 0.75) < 0.03


def without_repeats(words):
    """The plain way: drop the second of two equal neighbouring groups, longest and leftmost first, until there is none."""
    for size in range(len(words) // 2, 0, -1):
        for at in range(len(words) - 2 * size + 1):
            left, right = words[at : at + size], words[at + size : at + 2 * size]
            if [w.lower() for w in left] == [w.lower() for w in right]:
                return without_repeats(words[: at + size] + words[at + 2 * size :])
    return words


def test_adjacent_repeats(spark):
    import random

    rng = random.Random(7)
    rows = [" ".join(rng.choice(["a", "A", "bé", "BÉ", "c.d"]) for _ in range(rng.randint(0, 5))) for _ in range(150)]
    rows += ["x y x y x y", "một hai Một hai ba", "a a b a a b", "(a (a", "", "a\\1 a\\1", "$1 $1", "hồ hồ hồ hồ Hồ", "ngõ 1 ngõ 1 ngõ 2"]
    got = values(spark, [(r,) for r in rows], names.adjacent_repeats)
    assert got == [" ".join(without_repeats(r.split(" "))) for r in rows]
