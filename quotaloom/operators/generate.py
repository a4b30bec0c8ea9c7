"""Composing sentences from plan cells, entities and templates (survey R1-R12, W3, W5, W6, N8, J12-J16, F13-F15, F23, F24).

Every draw is a hash of (seed, cell, number in the cell, axis), so a row's text depends on nothing but its own keys: cells are
independent, any partitioning gives the same rows, and a lost task recomputes the same. Draws are staged columns, each seeing
the ones before it. The audit columns are taken from the composed parts, not from the draws.

A cell's pool is joined on (province, category); only entities whose race key is high enough to be among the target's are shuffled and ranked.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotaloom.functions import names as N
from quotaloom.functions import numbers as D
from quotaloom.functions.draws import pick, race_key, sample_id, uniform, weighted_pick
from quotaloom.functions.templates import substitute
from quotaloom.operators.quota import largest_remainder, normalized
from quotaloom.workspace import cut


# The default weights of the axes and of entities by tier.
@dataclass(frozen=True)
class Style:
    """Weights of the axes, by ``default``, register and category (the category wins), rates and words of the slots."""

    seed: str = "42"
    tiers: tuple = (5.0, 2.0, 1.0)
    admin_shares: dict = field(default_factory=lambda: {"province": 0.30, "district": 0.05, "ward": 0.65})
    depth: dict = field(default_factory=lambda: {"default": [("poi_only", 0.55), ("poi_district", 0.30), ("full_address", 0.15)], "admin_unit": [("poi_only", 0.75), ("poi_district", 0.20), ("full_address", 0.05)],
                                                "address": [("poi_only", 0.15), ("poi_district", 0.40), ("full_address", 0.45)]})
    variant: dict = field(default_factory=lambda: {"default": [("current", 0.78), ("legacy", 0.15), ("spoken_alias", 0.07)], "admin_unit": [("current", 0.62), ("legacy", 0.28), ("spoken_alias", 0.10)]})
    number: dict = field(default_factory=lambda: {"default": [("cardinal", 0.50), ("digit_by_digit", 0.18), ("mixed", 0.07), ("none", 0.25)], "address": [("cardinal", 0.58), ("digit_by_digit", 0.25), ("mixed", 0.12), ("none", 0.05)]})
    prefix: dict = field(default_factory=lambda: {"default": [("present", 0.60), ("absent", 0.40)], "formal": [("present", 0.85), ("absent", 0.15)], "casual": [("present", 0.40), ("absent", 0.60)], "admin_unit": [("present", 0.85), ("absent", 0.15)]})
    marker: float = 0.45
    number_word: float = 0.45
    openers: dict = field(default_factory=lambda: {"formal": (0.45, [("cho tôi hỏi", True), ("xin hỏi", True)]), "neutral": (0.40, [("cho hỏi", True), ("này", False)]), "casual": (0.55, [("ê", False), ("ơ", False), ("à", False)])})
    closers: dict = field(default_factory=lambda: {"formal": (0.55, ["được không", "nhé"]), "neutral": (0.50, ["nhé", "với"]), "casual": (0.70, ["với", "đi"])})
    fillers: dict = field(default_factory=lambda: {"formal": (0.0, []), "neutral": (0.08, ["thì"]), "casual": (0.25, ["kiểu", "tự dưng"])})
    nouns: tuple = ("quán", "chỗ", "điểm")
    house_max: int = 300
    alley_rate: float = 0.30
    letter_rate: float = 0.15


def _u(style: Style, axis: str) -> Column:
    return uniform(style.seed, F.col("cell"), F.col("i").cast("string"), axis)


def _axis(style: Style, weights: dict, axis: str, use_category: bool = True) -> Column:
    """J18 as a ladder over a fixed table of weights."""
    u, out = _u(style, axis), None
    keys = [k for k in weights if k != "default"]
    for k in sorted(keys, key=lambda k: k in ("formal", "neutral", "casual")):  # categories first
        is_register = k in ("formal", "neutral", "casual")
        if is_register or use_category:
            hit = (F.col("register") if is_register else F.col("category")) == k
            out = F.when(hit, weighted_pick(weights[k], u)) if out is None else out.when(hit, weighted_pick(weights[k], u))
    default = weighted_pick(weights["default"], u)
    return default if out is None else out.otherwise(default)


def cell_groups(cells: DataFrame, pool: DataFrame, style: Style) -> DataFrame:
    """(cell's columns, pool_category, grp, quota, offset, size, floor_key) for each group of a cell's pool.

    A cell of admin units is divided among its province, districts and wards by fixed shares, which groups without a unit leave to the
    others; every other cell is one group. Groups follow one another in the order of their names: ``offset`` is the number of rows before.
    ``floor_key`` is a race key that more than enough of the group's entities are expected to reach: their number is the sum of
    n (1 - t^w) over the weights w, solved by bisection.
    """
    sizes = pool.groupBy("province_id", F.col("category").alias("pool_category"), "grp").agg(
        F.count("*").alias("size"), *[F.count_if(F.col("weight") == w).cast("double").alias(f"_n{k}") for k, w in enumerate(style.tiers)]
    )
    joined = cells.withColumn("pool_category", F.when(F.col("category") == "address", "street").otherwise(F.col("category"))).join(sizes, ["province_id", "pool_category"])
    weight = F.coalesce(*[F.when(F.col("grp") == k, v) for k, v in style.admin_shares.items()], F.lit(1.0))
    out = normalized(joined.withColumn("_w", weight), "_w", ["cell"])
    out = largest_remainder(out, "share", F.col("target"), ["grp"], ["cell"], "quota").filter("quota > 0")
    before = F.sum("quota").over(Window.partitionBy("cell").orderBy("grp")) - F.col("quota")
    want = F.least("quota", "size")
    enough = want + 6 * F.sqrt(want.cast("double")) + 12

    def reached(t: Column) -> Column:
        return sum((F.col(f"_n{k}") * (1 - F.pow(t, F.lit(w))) for k, w in enumerate(style.tiers)), F.lit(0.0))

    def halve(s: Column, _: Column) -> Column:
        t = (s["lo"] + s["hi"]) / 2
        return F.struct(F.when(reached(t) >= enough, t).otherwise(s["lo"]).alias("lo"), F.when(reached(t) >= enough, s["hi"]).otherwise(t).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")), halve)["lo"]
    out = out.withColumn("offset", before).withColumn("floor_key", F.when(enough >= F.col("size"), 0.0).otherwise(found))
    return out.drop("_w", "share", *[f"_n{k}" for k in range(len(style.tiers))])


def draw_entities(cells: DataFrame, pool: DataFrame, style: Style) -> DataFrame:
    """(cell, i, lap, entity columns) for i below each cell's target, in weighted order without
    replacement, again from the front when a group of the pool is used up. Cells without a pool give no rows.

    Only entities above the group's floor key are shuffled and ranked, about as many as it needs. A group that they don't suffice
    for, next to none, takes its whole pool. With ``have`` among the cells' columns, rows below that number are left out.
    """
    groups = cut(cell_groups(cells, pool, style), "groups")
    keyed = pool.withColumnRenamed("category", "pool_category").join(groups, ["province_id", "pool_category", "grp"])
    keyed = keyed.withColumn("_key", race_key(uniform(style.seed, F.col("cell"), F.col("entity_id"), "order"), F.col("weight")))
    drawn = cut(keyed.filter(F.col("_key") >= F.round("floor_key", 12)), "drawn")
    short = groups.join(drawn.groupBy("cell", "grp").agg(F.count("*").alias("_got")), ["cell", "grp"], "left").filter(F.coalesce("_got", F.lit(0)) < F.least("quota", "size")).select("cell", "grp")
    short = cut(short, "short")
    if not short.isEmpty():
        drawn = drawn.join(short, ["cell", "grp"], "left_anti").unionByName(keyed.join(short, ["cell", "grp"], "left_semi").select(*drawn.columns))
    w = Window.partitionBy("cell", "grp").orderBy(F.col("_key").desc(), "entity_id")
    ranked = drawn.withColumn("_rank", F.row_number().over(w) - 1).filter(F.col("_rank") < F.col("quota"))
    out = ranked.withColumn("lap", F.explode(F.sequence(F.lit(0), F.floor((F.col("quota") - 1 - F.col("_rank")) / F.col("size")).cast("int"))))
    out = out.withColumn("i", (F.col("offset") + F.col("_rank") + F.col("lap") * F.col("size")).cast("long"))
    out = out.filter(F.col("i") >= F.col("have")).drop("have") if "have" in cells.columns else out
    return out.drop("_rank", "_key", "size", "offset", "quota", "floor_key", "grp", "pool_category")


def assign_templates(rows: DataFrame, templates: DataFrame, seed: str) -> DataFrame:
    """An entity's uses in a cell take templates from a hashed start onwards, so no pair repeats before all are used;
    ``repeated`` tells a pair that does. ``templates`` has (sentence_type, profile, ordinal, n, ...)."""
    n = templates.groupBy("sentence_type", "profile").agg(F.count("*").alias("n_templates"))
    start = F.floor(uniform(seed, F.col("cell"), F.col("entity_id"), "template") * F.col("n_templates")).cast("long")
    at = rows.join(n, ["sentence_type", "profile"]).withColumn("ordinal", F.pmod(start + F.col("lap"), F.col("n_templates")))
    return at.withColumn("repeated", F.col("lap") >= F.col("n_templates")).join(templates, ["sentence_type", "profile", "ordinal"])


def draw_axes(rows: DataFrame, style: Style) -> DataFrame:
    """The axes in their order of dependence."""
    has_district = F.coalesce(F.col("district") != "", F.lit(False))
    has_number = (F.col("category") == "address") | F.col("name").rlike("[0-9]")
    depth = _axis(style, style.depth, "depth")
    rows = rows.withColumn("depth", F.when((depth == "poi_district") & ~has_district, "full_address").otherwise(depth))
    names_province = (F.col("subcategory") == "province") | (F.col("depth") == "full_address")
    number = _axis(style, style.number, "number")
    prefixed = F.col("category").isin("admin_unit", "street", "address")
    rows = rows.withColumns({
        "drawn_variant": F.when(names_province, _axis(style, style.variant, "variant")).otherwise("current"),
        "number_style": F.when(has_number, F.when(number == "none", "cardinal").otherwise(number)).otherwise("none"),
        "admin_prefix": prefixed & (_axis(style, style.prefix, "prefix") == "present"),
        "tail_prefix": (F.col("depth") != "poi_only") & (_axis(style, style.prefix, "tail_prefix", use_category=False) == "present"),
    })
    return rows.withColumns({
        "drawn_marker": (F.col("drawn_variant") == "legacy") & (_u(style, "marker") < style.marker),
        "number_word": (F.col("number_style") != "none") & N.number_leads(F.col("name"), F.col("category")) & (_u(style, "number_word") < style.number_word),
    })


def alias_candidates(aliases: DataFrame, provinces: DataFrame) -> DataFrame:
    """Per province the usable legacy and spoken aliases; an unchanged province's own name is no legacy alias."""
    a = aliases.join(provinces.select("province_id", "name_current", "admin_status"), "province_id")
    usable = (F.col("alias_type") != "legacy") | (F.col("admin_status") == "merged") | (F.lower("alias") != F.lower("name_current"))
    entry = F.struct(F.col("alias").alias("alias"), F.coalesce("admin_prefix", F.lit("")).alias("prefix"))
    g = a.filter(usable & F.col("alias").isNotNull()).groupBy("province_id")
    sets = g.agg(*[F.array_sort(F.collect_set(F.when(F.col("alias_type") == t, entry))).alias(n) for t, n in (("legacy", "legacy"), ("spoken", "spoken"))])
    out = provinces.select("province_id", "name_current", "is_municipality").join(sets, "province_id", "left")
    return out.withColumn("unambiguous", F.coalesce(F.size("legacy"), F.lit(0)) <= 1)


def resolve_names(rows: DataFrame, candidates: DataFrame, style: Style) -> DataFrame:
    """The province's name in the drawn variant; without a candidate the current name, and the variant says so.

    A hint narrows the legacy names to itself, unless it is none of them. Another entity than the province takes a legacy name only
    with a hint or where there is one alone.
    """
    rows = rows.join(candidates, "province_id", "left")
    none = F.array().cast("array<struct<alias:string,prefix:string>>")
    hinted = F.coalesce(F.col("hint") != "", F.lit(False)) & (F.col("subcategory") != "province")
    own = F.filter("legacy", lambda x: x["alias"] == F.col("hint"))
    legacy = F.when(hinted & (F.size(own) > 0), own).otherwise(F.coalesce("legacy", none))
    legacy_ok = (F.col("subcategory") == "province") | hinted | F.col("unambiguous")
    options = F.when((F.col("drawn_variant") == "legacy") & legacy_ok, legacy).when(F.col("drawn_variant") == "spoken_alias", F.coalesce("spoken", none)).otherwise(none)
    rows = rows.withColumn("_alias", pick(options, _u(style, "alias")))
    found = F.col("_alias").isNotNull()
    prefix = F.when(F.col("is_municipality"), "thành phố").otherwise("tỉnh")
    rows = rows.withColumns({
        "name_variant": F.when(found, F.col("drawn_variant")).otherwise("current"),
        "marker": F.col("drawn_marker") & found & (F.col("drawn_variant") == "legacy"),
        "province_name": F.when(found, F.col("_alias.alias")).otherwise(F.col("name_current")),
        "province_prefix": F.when(found, F.col("_alias.prefix")).otherwise(prefix),
    })
    return rows.drop("_alias", "legacy", "spoken", "unambiguous", "is_municipality")


def _joined(*parts: Column) -> Column:
    return F.trim(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))


def house_number(style: Style) -> Column:
    """R6."""
    n = (1 + F.floor(_u(style, "house") * style.house_max)).cast("string")
    alley = F.when(_u(style, "alley?") < style.alley_rate, F.concat(F.lit("/"), (1 + F.floor(_u(style, "alley") * 99)).cast("string"))).otherwise("")
    letter = F.when(_u(style, "letter?") < style.letter_rate, F.char((65 + F.floor(_u(style, "letter") * 26)).cast("int"))).otherwise("")
    return F.concat(n, alley, letter)


def compose(rows: DataFrame, style: Style) -> DataFrame:
    """The entity's phrase, its address tail, and the audit columns of what was said: district, ward, street, address,
    and whether an admin prefix was."""
    read = F.col("_read")
    rows = rows.withColumns({
        "_read": F.when(F.col("number_style") == "none", F.lit(D.CARDINAL)).otherwise(F.col("number_style")),
        "_number": F.when(F.col("category") == "address", house_number(style)),
    })
    said = {}
    for field in ("name", "district"):  # names without digits or abbreviations keep clear of the reading
        c = F.col(field)
        said[f"_{field}"] = F.when(c.rlike("[0-9]"), D.verbalize_name(c, read)).otherwise(D.expand_abbreviations(c))
    rows = rows.withColumns(said | {"_house": D.read_house_number(F.col("_number"), read)})
    spoken = F.col("_name")
    word, rest = N.street_prefix(spoken)
    rows = rows.withColumns({"_word": word, "_rest": rest})
    word, rest = F.col("_word"), F.col("_rest")
    marked = F.when(F.col("marker"), "cũ").otherwise("")
    unit, sub = F.col("category") == "admin_unit", F.col("subcategory")
    is_street = F.col("category").isin("street", "address")
    province = _joined(F.when(F.col("admin_prefix"), F.col("province_prefix")).otherwise(""), F.col("province_name"), marked)
    decorative = F.coalesce(word.isin("Đường", "Phố"), F.lit(False))
    street_word = F.when(decorative & ~F.col("admin_prefix"), "").when(word.isNotNull(), F.lower(word)).when(F.col("admin_prefix"), "đường").otherwise("")
    so = F.when(F.col("number_word"), "số").otherwise("")
    street = N.lower_street_words(_joined(street_word, so, rest))
    address_word = F.coalesce(F.lower(word), F.when(F.col("admin_prefix"), "đường").otherwise(""))
    address = N.lower_street_words(_joined(so, F.col("_house"), address_word, rest))
    typed = F.col("admin_prefix") & (F.col("unit_type") != "") & ~N.embeds_type(spoken, F.col("unit_type"))
    core = (
        F.when(F.col("category") == "address", address).when(F.col("category") == "street", street).when(sub == "province", province)
        .when(unit, _joined(F.when(typed, F.col("unit_type")).otherwise(""), spoken)).otherwise(spoken)
    )
    in_district = (F.col("depth") == "poi_district") & ~(unit & sub.isin("province", "district"))
    in_province = (F.col("depth") == "full_address") & ~(unit & (sub == "province"))
    district_typed = F.col("tail_prefix") & (F.col("district_type") != "") & ~N.embeds_type(F.col("district"), F.col("district_type"))
    tail = F.when(in_district, _joined(F.lit("ở"), F.when(district_typed, F.col("district_type")).otherwise(""), F.col("_district")))
    tail = tail.when(in_province, _joined(F.lit("ở"), F.when(F.col("tail_prefix"), F.col("province_prefix")).otherwise(""), F.col("province_name"), marked))
    prefixed = (
        F.when(F.col("category") == "address", address_word != "").when(F.col("category") == "street", street_word != "")
        .when(sub == "province", F.col("admin_prefix") & (F.col("province_prefix") != "")).when(unit, typed).otherwise(False)
    )
    tail_prefixed = F.when(in_district, district_typed).when(in_province, F.col("tail_prefix") & (F.col("province_prefix") != "")).otherwise(False)
    return rows.withColumns({
        "_core": core, "_tail": F.coalesce(tail, F.lit("")), "prefix_said": F.coalesce(prefixed | tail_prefixed, F.lit(False)),
        "said_district": F.when(unit & (sub == "district"), F.col("name")).when(in_district, F.col("district")),
        "said_ward": F.when(unit & (sub == "ward"), F.col("name")), "said_street": F.when(is_street, F.col("name")),
        "said_address": F.when(F.col("category") == "address", F.concat_ws(" ", "_number", "name")),
        "says_province": (unit & (sub == "province")) | in_province,
    }).withColumn("phrase", _joined(F.col("_core"), F.col("_tail")))


def _slot(style: Style, table: dict, axis: str, keep=lambda o: F.lit(True), text=lambda o: o) -> Column:
    """With the register's rate a uniform choice among the allowed words, else nothing."""
    out = None
    for register, (rate, options) in table.items():
        pool = F.array_compact(F.array(*[F.when(keep(o), text(o)) for o in options])) if options else F.array().cast("array<string>")
        value = F.when(_u(style, axis + "?") < rate, F.coalesce(pick(pool, _u(style, axis)), F.lit(""))).otherwise("")
        hit = F.col("register") == register
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise("")


def fill_slots(rows: DataFrame, style: Style) -> DataFrame:
    """Opener with merged filler, closer, noun; asking openers only before statements that don't ask themselves."""
    opener = _slot(style, style.openers, "opener", lambda o: F.lit(not o[1]) | ((F.col("head") == "statement") & ~F.col("asks")), lambda o: F.lit(o[0]))
    closer = _slot(style, style.closers, "closer", lambda c: (F.col("tail") == "plain") & (~F.lit("giúp" in c) | ~F.col("helps")), F.lit)
    filler = _slot(style, style.fillers, "filler", lambda f: F.col("head") == "statement", F.lit)
    rows = rows.withColumns({"_o": opener, "_f": filler})
    doubled = (F.col("_o") == F.col("_f")) | F.col("_o").startswith(F.concat(F.col("_f"), F.lit(" ")))
    opener = F.when((F.col("_f") == "") | doubled, F.col("_o")).otherwise(_joined(F.col("_f"), F.col("_o")))
    noun = pick(F.array(*[F.lit(n) for n in style.nouns]), _u(style, "noun"))
    text = substitute(F.col("template_text"), opener=opener, closer=closer, category_noun=noun, entity=F.col("phrase"))
    return rows.withColumn("text", text).drop("_o", "_f")


def drawn(cells: DataFrame, pool: DataFrame, templates: DataFrame, style: Style) -> DataFrame:
    """The rows with entity, template and axes, before any text is composed."""
    return draw_axes(assign_templates(draw_entities(cells, pool, style), templates, style.seed), style)


def generate(cells: DataFrame, pool: DataFrame, templates: DataFrame, candidates: DataFrame, style: Style) -> DataFrame:
    """Exactly ``target`` rows of every cell that has a pool and templates, in the columns of a sample, and their number i."""
    rows = fill_slots(compose(resolve_names(drawn(cells, pool, templates, style), candidates, style), style), style)
    said = F.when(F.col("says_province"), F.col("name_variant")).otherwise("current")
    variation = F.concat_ws("+", said, "number_style", F.when(F.col("prefix_said"), "prefix").otherwise("no_prefix"), "register")
    legacy = F.when(said == "legacy", F.col("province_name"))
    kind = F.when(F.col("category") == "address", "house_address").otherwise(F.col("subcategory"))
    return rows.select(
        sample_id(F.col("cell"), F.col("i")).alias("id"), "text", "category", kind.alias("subcategory"), F.col("phrase").alias("entity"), "entity_id", F.col("name_current").alias("province"),
        legacy.alias("province_legacy"), F.col("said_district").alias("district"), F.col("said_ward").alias("ward"), F.col("said_street").alias("street"), F.col("said_address").alias("address"),
        "sentence_type", "template_id", variation.alias("variation"), said.alias("name_variant"), "number_style", "register", "source", F.col("cell").alias("seed_cell"), "i", "repeated",
    )


def reject_counts(cells: DataFrame, pool: DataFrame, templates: DataFrame) -> DataFrame:
    """(cell, reason, n): planned rows of cells without a pool or without templates."""
    by_pool = cells.withColumn("pool_category", F.when(F.col("category") == "address", "street").otherwise(F.col("category")))
    have = pool.select("province_id", F.col("category").alias("pool_category")).distinct()
    no_template = cells.join(templates.select("sentence_type", "profile").distinct(), ["sentence_type", "profile"], "left_anti").select("cell", F.lit("no_template").alias("reason"), F.col("target").alias("n"))
    no_pool = by_pool.join(templates.select("sentence_type", "profile").distinct(), ["sentence_type", "profile"], "left_semi").join(have, ["province_id", "pool_category"], "left_anti")
    return no_template.unionByName(no_pool.select("cell", F.lit("empty_pool").alias("reason"), F.col("target").alias("n")))
