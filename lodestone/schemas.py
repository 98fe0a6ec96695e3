"""Explicit schemas of the record model (nothing is inferred)."""

from __future__ import annotations

POPULATION = "array<struct<year:int,count:bigint>>"
EXTRACTION = (
    "name string, variant_names array<string>, feature_term string, aat_type_id string, country string, country_code string, admin_hierarchy array<string>, "
    "spatial_relations array<struct<reference:string,bearing:string,distance_value:double,distance_unit:string>>, latitude double, longitude double, "
    f"population {POPULATION}, area string, peoples array<struct<name:string,relation:string>>, notes array<string>"
)
RESPONSE = f"places array<struct<{EXTRACTION.replace(' array', ':array').replace(' string', ':string').replace(' double', ':double')}>>, ocr_corrections array<struct<original:string,corrected:string>>"
PAGE_GEOMETRY = "volume string, idx int, w int, h int, layout array<struct<label:string,bbox:array<int>>>, lines array<struct<bbox:array<int>,text:string>>"
SOURCE = "source_id bigint, filename string, sha256 string, n_entries bigint, n_crossrefs bigint, page_min int, page_max int, imported_at string"
ENTRY = (
    "entry_id bigint, source_id bigint, seq int, kind string, headword string, headword_raw string, headword_disp string, page_start int, page_end int, raw_html string, "
    "text string, n_tables int, n_also int, table_missing int, see_target string, tokens bigint"
)
PLACE = (
    "place_id bigint, entry_id bigint, ordinal int, name string, extraction string, aat_type_id string, status string, match_id string, lat double, lon double, "
    "created_at string, reconciliation string, match_score double, recon_pass string"
)
LLM_CACHE = "key string, provider string, model string, entry_id bigint, response_json string, usage_json string, created_at string"
SHARD_LINE = "entry_id bigint, key string, provider string, model string, response_json string, usage string"
TABLE_DATA = (
    "id bigint, entry_id bigint, table_no int, headword string, page_start int, n_rows int, n_cols int, subject string, header string, columns array<struct<label:string,`group`:string,unit:string,type:string>>, "
    "rows array<array<string>>, source_note string, footnotes array<string>, created_at string, volume string, source string"
)
NAME_VARIANT = "id bigint, page_idx int, direction string, headword string, equivalents array<string>, note string, created_at string"
PAGE_TRIAGE = "volume string, idx int, type string, n_tables int, n_images int, plate_kind string, plate_title string, created_at string"
VLM_QA = "id bigint, volume string, page int, kind string, name string, detail string, created_at string"
QA = "entry_id bigint, flags string, idx_sim double, idx_hit string, verdict string"
DECISION = "sig string, headword string, action string, payload string, ts string"
GAZETTEER_HIT = "place_id string, title string, names array<string>, country_code string, containers array<string>, lat double, lon double, has_geom boolean"
BACK_MATTER = "id bigint, source_id bigint, kind string, text string, n_lines int"
