"""Schemas of the stored tables (survey 1.3) and of raw inputs. File, column and key names are fixed values of the format."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _typed(base: T.StructType, **kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in base])


#: On disk every column of a master table is a string; empty means null.
MASTER_FILES = {
    "provinces": _strings("province_id", "name_current", "admin_status", "region", "is_municipality", "popularity_tier"),
    "province_alias": _strings("province_id", "alias", "alias_type", "weight", "admin_prefix"),
    "districts": _strings("district_id", "province_id", "name", "type", "status", "legacy_alias"),
    "wards": _strings("ward_id", "district_id", "province_id", "name", "type", "legacy_alias"),
    "streets": _strings("street_id", "province_id", "district_id", "name", "street_type"),
    "pois": _strings("poi_id", "name", "category", "subcategory", "ward_id", "district_id", "province_id", "popularity_tier", "source", "osm_id", "legacy_alias_hint"),
}
MASTER = {
    "provinces": _typed(MASTER_FILES["provinces"], is_municipality=T.BooleanType(), popularity_tier=T.IntegerType()),
    "province_alias": _typed(MASTER_FILES["province_alias"], weight=T.DoubleType()),
    "districts": MASTER_FILES["districts"],
    "wards": MASTER_FILES["wards"],
    "streets": MASTER_FILES["streets"],
    "pois": _typed(MASTER_FILES["pois"], popularity_tier=T.IntegerType()),
}
#: The order of rows on disk.
SORT_KEYS = {
    "provinces": ["province_id"], "province_alias": ["province_id", "alias_type", "alias"], "districts": ["district_id"], "wards": ["ward_id"],
    "streets": ["street_id"], "pois": ["poi_id"],
}
#: Columns that keep "" instead of null.
KEEP_EMPTY = {"admin_prefix"}
SAMPLES = _strings(
    "id", "text", "category", "subcategory", "entity", "entity_id", "province", "province_legacy", "district", "ward", "street", "address", "sentence_type",
    "template_id", "variation", "name_variant", "number_style", "register", "source", "seed_cell",
)
SNAPSHOT = "province_id string, bbox array<double>, elements array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"
PLAN = "schema_version int, run_id string, total long, global_seed long, cells array<struct<province_id:string,category:string,sentence_type:string,variation_profile:string,target_count:int>>"
PLAN_VERSION = 1
