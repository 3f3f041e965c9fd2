"""DuckDB SQL for the registered queries: the rules written out naively, pair by pair where they compare pairs."""

from __future__ import annotations

from shelfmatch.checks.fixtures import STATEMENTS
from shelfmatch.functions import text as tx

SPLIT = "timestamp '1998-06-01 00:00:00'"
NOW = "timestamp '2024-01-31 00:30:00'"


# ---- expressions ----

def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(quoted(v) for v in values)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def blank(x: str) -> str:
    return f"coalesce({x}, '')"


def words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def joined(tokens: str) -> str:
    return f"coalesce(array_to_string({tokens}, ' '), '')"


def expanded(tokens: str, table: dict[str, str]) -> str:
    entries = ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in table.items())
    return f"list_transform({tokens}, lambda w: coalesce(map {{{entries}}}[w], w))"


def no_punctuation(x: str) -> str:
    return f"regexp_replace({x}, '[[:punct:]]', '', 'g')"


def norm_addr(x: str) -> str:
    return joined(expanded(words(no_punctuation(f"lower({blank(x)})")), tx.ADDRESS_ABBREVIATIONS))


def norm_name(x: str) -> str:
    x = f"regexp_replace({blank(x)}, {quoted(tx.COMPANY_WORDS)}, '', 'gi')"
    x = rf"regexp_replace({x}, '\s*&\s*', ' and ', 'g')"
    x = rf"regexp_replace({x}, '''s\b', 's', 'gi')"
    singular = ("case when length(w) > 3 and ends_with(w, 's') and not ends_with(w, 'ss') "
                "then left(w, length(w) - 1) else w end")
    return joined(f"list_transform({words(no_punctuation(f'lower({x})'))}, lambda w: {singular})")


def name_key(normalised: str) -> str:
    return joined(f"list_filter({words(normalised)}, lambda k: k not in ({listed(tx.GENERIC_NAME_WORDS)}))")


def is_cannabis(x: str) -> str:
    return f"list_has_any({words(f'lower({blank(x)})')}, [{listed(tx.CANNABIS_WORDS)}])"


def norm_city(x: str) -> str:
    return strip(f"lower({blank(x)})")


def house_num(addr: str) -> str:
    return f"nullif(regexp_extract({addr}, '^([0-9]+)( |$)', 1), '')"


def norm_id(x: str) -> str:
    spaced = rf"regexp_replace(lower({blank(x)}), '[^\w\s]', ' ', 'g')"
    return joined(expanded(words(spaced), tx.IDENTITY_ABBREVIATIONS))


def store_id() -> str:
    return "md5(" + " || '|' || ".join(
        norm_id(x) for x in ("store_name", "house_number", "road", "parsed_city", "state")) + ")"


def parse_bool(x: str) -> str:
    v = f"lower({strip(blank(x))})"
    return (f"case when {v} in ('true', '1', 'yes', 'y') then true "
            f"when {v} in ('false', '0', 'no', 'n', '') then false end")


def parse_float(x: str) -> str:
    v = strip(x)
    digits = "[0-9]+(_[0-9]+)*"
    pattern = rf"[+-]?({digits}\.?({digits})?|\.{digits})([eE][+-]?{digits})?"
    return f"case when regexp_full_match({v}, '{pattern}') then try_cast(replace({v}, '_', '') as double) end"


def parse_int(x: str) -> str:
    return f"cast(trunc({parse_float(x)}) as bigint)"


def parse_text(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def sorted_words(x: str) -> str:
    return joined(f"list_sort({words(x)})")


def ratio(a: str, b: str, kind: str = "bigint") -> str:
    """Bit-parallel LCS, one step per character of ``b``; ``a`` has at most 62 characters (125 as ``hugeint``)."""
    full = f"((1::{kind} << length({a})) - 1)"
    mask = (f"coalesce(list_sum(list_transform(range(length({a})), "
            f"lambda i: case when {a}[i + 1] = ch then 1::{kind} << i::int else 0::{kind} end)), 0)::{kind}")
    steps = f"list_prepend({full}, list_transform(string_split({b}, ''), lambda ch: {mask}))"
    state = f"list_reduce({steps}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})"
    return (f"(case when length({a}) + length({b}) = 0 then 100.0::double "
            f"else 200.0::double * (length({a}) - bit_count({state}))::double / (length({a}) + length({b}))::double end)")


# ---- common table expressions ----

def with_(*parts: str) -> str:
    """Names of derived tables, or ``name as (...)`` text."""
    ctes = [part if " as " in part else f"{part} as ({STATEMENTS[part]})" for part in parts]
    return "with " + ",\n".join(ctes) + "\n"


STORE_KEYS = [
    f"""st0 as (select store_id, {blank('store_name')} as name, {blank('address')} as address,
 {blank('parsed_city')} as city, {blank('state')} as state, {blank('zip')} as zip_code from stores)""",
    f"""st1 as (select *, {norm_addr("(address || ' ' || city || ' ' || state)")} as norm_addr,
 {norm_name('name')} as norm_name, {norm_city('city')} as norm_city, upper(state) as st,
 {is_cannabis('name')} as cannabis from st0)""",
    f"""st2 as (select *, {name_key('norm_name')} as k, {house_num('norm_addr')} as house from st1)""",
    f"""st as (select *, {sorted_words('k')} as kw, {sorted_words('norm_addr')} as aw,
 len(list_filter({words('k')}, lambda t: not list_contains({words('norm_city')}, t))) = 0 as city_only from st2)""",
]
ACCOUNT_KEYS = [
    f"""ac0 as (select distributor as distributor_name, account_id as source_id, original_name,
 {blank('clean_name')} as name, {blank('clean_address')} as address, {blank('city')} as city,
 {blank('state')} as state, {blank('zip_code')} as zip_code, cast(case_volume as double) as case_volume,
 cast(revenue as double) as revenue, cast(revenue_per_case as double) as revenue_per_case from accounts)""",
    f"""ac1 as (select *, {norm_addr("(address || ' ' || city || ' ' || state)")} as norm_addr,
 {norm_name('name')} as norm_name, {norm_city('city')} as norm_city, upper(state) as st from ac0)""",
    f"""ac2 as (select *, {name_key('norm_name')} as k, {house_num('norm_addr')} as house from ac1)""",
    f"""ac as (select *, {sorted_words('k')} as kw, {sorted_words('norm_addr')} as aw from ac2)""",
]
SIDES = ["stores", "accounts", *STORE_KEYS, *ACCOUNT_KEYS]

# Scores of the distinct texts that meet.
CITY_SCORES = f"""city_scores as materialized (select x, y, {ratio('x', 'y')} as score from
 (select distinct norm_city as x from st) cross join (select distinct norm_city as y from ac))"""
NAME_SCORES = f"""name_scores as materialized (select x, y, {ratio('x', 'y')} as score from
 (select distinct kw as x from st where kw <> '') cross join (select distinct kw as y from ac where kw <> ''))"""
LOOSE_PAIRS = """loose_pairs as materialized (select s.store_id, a.distributor_name, a.source_id, s.kw as s_kw,
 a.kw as a_kw, s.aw as s_aw, a.aw as a_aw, a.st = s.st as own_state, s.norm_city <> '' or s.zip_code <> '' as anchored
 from st s join ac a on a.st = s.st or a.st = '' where not s.cannabis and (s.norm_city = '' or a.norm_city = '')
 and (s.house is null or a.house is null or s.house = a.house))"""
ADDRESS_SCORES = f"""address_scores as materialized (select x, y, {ratio('x', 'y')} as score from
 (select distinct s_aw as x, a_aw as y from loose_pairs))"""
SCORES = [CITY_SCORES, NAME_SCORES, LOOSE_PAIRS, ADDRESS_SCORES]

L1 = """l1 as (select s.store_id, w.distributor_name, 1 as rank, 'exact_address' as match_layer,
 100.0::double as match_confidence, 'confirmed' as match_status, w.source_id from st s join
 (select distributor_name, norm_addr, max(source_id) as source_id from ac where norm_addr <> '' group by all) w
 on w.norm_addr = s.norm_addr)"""
L2 = """l2 as (select s.store_id, w.distributor_name, 2 as rank, 'exact_name' as match_layer,
 100.0::double as match_confidence, 'confirmed' as match_status, w.source_id from st s join
 (select distributor_name, norm_name, max(source_id) as source_id from ac where norm_name <> '' group by all) w
 on w.norm_name = s.norm_name join ac a on a.distributor_name = w.distributor_name and a.source_id = w.source_id
 left join city_scores cs on cs.x = s.norm_city and cs.y = a.norm_city
 where (a.st = '' or a.st = s.st) and (s.norm_city = '' or a.norm_city = '' or cs.score >= 80)
 and (s.norm_city <> '' or s.zip_code = '' or a.zip_code = '' or s.zip_code = a.zip_code))"""
L2B = """l2b as (select store_id, distributor_name, 3 as rank, 'fuzzy_name_zip' as match_layer,
 score as match_confidence, case when score >= 85 then 'confirmed' else 'flagged' end as match_status, source_id from
 (select s.store_id, a.distributor_name, a.source_id, n.score, row_number() over (
   partition by s.store_id, a.distributor_name order by n.score desc, a.source_id) as pos
  from st s join ac a on a.zip_code = s.zip_code join name_scores n on n.x = s.kw and n.y = a.kw
  where s.zip_code <> '' and (s.house is null or a.house is null or s.house = a.house)) where pos = 1 and score >= 75)"""
CITY_PAIRS = """city_pairs as (select s.store_id, a.distributor_name, a.source_id, n.score, 'fuzzy_name_city' as layer,
 a.st = s.st as own_state, s.norm_city <> '' or s.zip_code <> '' as anchored
 from st s join ac a on a.st = s.st or a.st = ''
 join city_scores cs on cs.x = s.norm_city and cs.y = a.norm_city and cs.score >= 86
 join name_scores n on n.x = s.kw and n.y = a.kw
 where not s.cannabis and not s.city_only and s.norm_city <> '' and a.norm_city <> '')"""
LOOSE_SCORED = """loose_scored as (select store_id, distributor_name, source_id, greatest(name_score, address_score)
 as score, case when name_score >= address_score then 'fuzzy_name' else 'fuzzy_address' end as layer, own_state, anchored
 from (select p.*, coalesce(n.score, 0) as name_score, d.score as address_score from loose_pairs p
  join address_scores d on d.x = p.s_aw and d.y = p.a_aw left join name_scores n on n.x = p.s_kw and n.y = p.a_kw))"""


def state_layer(source: str) -> str:
    return f"""l3 as (select store_id, distributor_name, 4 as rank, layer as match_layer, score as match_confidence,
 case when score >= 85 then 'confirmed' else 'flagged' end as match_status, source_id from
 (select *, row_number() over (partition by store_id, distributor_name order by score >= 85 desc,
   case when score >= 85 then 0 else -score end, own_state desc, source_id) as pos
  from ({source}) where score >= 85 or (score >= 75 and anchored)) where pos = 1)"""


BOTH = """select store_id, distributor_name, source_id, score, layer, own_state, anchored from city_pairs union all
 select store_id, distributor_name, source_id, score, layer, own_state, anchored from loose_scored"""
CASCADE = [
    *SIDES, *SCORES, L1, L2, L2B, CITY_PAIRS, LOOSE_SCORED, state_layer(BOTH),
    """hits as (select * from (select *, row_number() over (partition by store_id, distributor_name order by rank) as pos
 from (select * from l1 union all select * from l2 union all select * from l2b union all select * from l3))
 where pos = 1)""",
    """flat as (select s.store_id, d.distributor_name, h.store_id is not null as matched, h.source_id as customer_id,
 a.original_name as customer_name, h.match_layer, h.match_confidence, h.match_status, a.case_volume, a.revenue,
 a.revenue_per_case from stores s cross join (select distinct distributor_name from ac) d
 left join hits h on h.store_id = s.store_id and h.distributor_name = d.distributor_name
 left join ac a on a.distributor_name = h.distributor_name and a.source_id = h.source_id)""",
]
HIT = "store_id, distributor_name, match_layer, match_confidence, match_status, source_id as customer_id"


def typed(source: str) -> str:
    return f"""typed as (select {store_id()} as store_id,
 {", ".join(f"{parse_text(x)} as {x}" for x in (
     "brand", "store_name", "address", "phone", "email", "parsed_country", "parsed_city", "house_number", "road",
     "zip", "state"))},
 {parse_bool('is_chain')} as is_chain, {parse_text('chain_name')} as chain_name, {parse_float('rating')} as rating,
 {parse_int('review_count')} as review_count, seen_at as ingested_at, source_file from {source})"""


TYPED = typed("scrapes")
_STORE_ORDER = ("brand, store_name, address, phone, email nulls first, parsed_country, parsed_city, house_number, road, "
                "zip nulls first, state, is_chain nulls first, chain_name nulls first, rating nulls first, "
                "review_count nulls first")


def latest(name: str, where: str, by: str) -> str:
    """One row per store: the greatest by ``by``, then by the rest of the row; null is the least value."""
    order = ", ".join(
        f"{x.removesuffix(' nulls first')} desc nulls last" for x in f"{by}, {_STORE_ORDER}".split(", "))
    return f"""{name} as (select * exclude (pos) from (select *, row_number() over (
 partition by store_id order by {order}) as pos from typed where {where}) where pos = 1)"""


MERGE = ["scrapes", TYPED, latest("earlier", f"ingested_at < {SPLIT}", "ingested_at, source_file"),
         latest("later", f"ingested_at >= {SPLIT}", "ingested_at, source_file")]
# One file row per store and arrival: that of the last scrape in it, the greatest text where two share a day.
LANDED = f"""landed as (select * exclude (pos) from (select *, row_number() over (
 partition by {store_id()}, seen_at >= {SPLIT} order by seen_at desc, source_file desc, brand desc, store_name desc,
 address desc, phone desc, email desc, parsed_country desc, parsed_city desc, house_number desc, road desc, zip desc,
 state desc, is_chain desc, chain_name desc, rating desc, review_count desc) as pos from scrapes) where pos = 1)"""
_ANSWERED = "zip is null and address is not null and left(store_id, 1) not in ('0', '1', '2', '3')"
BACKFILLED = f"""backfilled as (select store_id, address, case when {_ANSWERED}
 then substr(translate(store_id, 'abcdef', '123456'), 2, 5) else zip end as zip,
 case when {_ANSWERED} then 40.25::double end as lat, case when {_ANSWERED} then -74.5::double end as lng, rating
 from earlier)"""
UPSERTED = "select * from later union all select * from earlier where store_id not in (select store_id from later)"

_OK = ("(json_extract_string(body, '$.status') = 'OK' and json_extract(body, '$.results[0].geometry.location.lat') is not null"
       " and json_extract(body, '$.results[0].geometry.location.lng') is not null)")
_ZIP = ("left(list_filter(cast(json_extract(body, '$.results[0].address_components') as "
        "struct(\"types\" varchar[], short_name varchar)[]), lambda p: list_contains(p.types, 'postal_code'))[1]"
        ".short_name, 5)")
CLASSIFIED = f"""classified as (select store_id, case when {_OK} or json_extract_string(body, '$.status') in
 ('ZERO_RESULTS', 'INVALID_REQUEST') then json_extract_string(body, '$.status') else 'TRANSIENT' end
 as geocode_status,
 case when {_OK} then cast(json_extract(body, '$.results[0].geometry.location.lat') as double) end as lat,
 case when {_OK} then cast(json_extract(body, '$.results[0].geometry.location.lng') as double) end as lng,
 case when {_OK} then nullif({_ZIP}, '') end as zip,
 case when {_OK} then json_extract_string(body, '$.results[0].formatted_address') end as formatted_address,
 case when {_OK} then json_extract_string(body, '$.results[0].geometry.location_type') end as location_type
 from geocode_raw)"""
GEOCODES = ["geocode_raw", CLASSIFIED,
            f"geocodes as (select *, {NOW} as geocoded_at from classified where geocode_status <> 'TRANSIENT')"]
MART = "mart as (select *, case when is_chain then 40.5::double end as latitude from stores)"
MISSING = "latitude is null and address is not null"
REQUEST = """store_id, array_to_string(list_filter([address, parsed_city, state, zip], lambda p: p is not null), ', ')
 as geocode_query"""
_DENSITY = f"case when coalesce(density, '') = '' then 0 else {parse_float('density')} end"
_PEOPLE = f"case when coalesce(population, '') = '' then 0 else {parse_int('population')} end"


def area(d: str) -> str:
    return f"case when {d} >= 10000 then 'urban' when {d} >= 1000 then 'suburban' else 'rural' end"


ZIPS = ["zip_raw", f"""zips as (select *, {area('pop_density_sqmi')} as area_type from (select
 case when length({strip('zip')}) < 5 then lpad({strip('zip')}, 5, '0') else {strip('zip')} end as zip,
 {parse_text('city')} as city, upper({parse_text('state_id')}) as state, {parse_text('county_name')} as county,
 {parse_float('lat')} as latitude, {parse_float('lng')} as longitude, {_DENSITY} as pop_density_sqmi,
 {_PEOPLE} as population from zip_raw) where latitude is not null and longitude is not null
 and pop_density_sqmi is not null and population is not null)"""]
_SEGMENTS = r"list_transform(list_reverse(string_split(matched_address, ',')), lambda s: regexp_extract(s, '\b(\d{5})\b', 1))"
BATCH_ZIP = f"list_filter({_SEGMENTS}, lambda z: z <> '')[1]"
_LNG, _LAT = parse_float("string_split(coords, ',')[1]"), parse_float("string_split(coords, ',')[2]")
_BOTH = f"({_LNG}) is not null and ({_LAT}) is not null"
POINT = f"case when {_BOTH} then {_LAT} end as lat, case when {_BOTH} then {_LNG} end as lng"
UPDATES = ["census_raw", f"""updates as (select store_id, {BATCH_ZIP} as zip, {POINT} from census_raw
 where upper({strip('match_flag')}) in ('MATCH', 'TIED') and {BATCH_ZIP} is not null)"""]
BATCH_LINE = ("store_id || ',' || " + " || ',' || ".join(
    strip(f"replace({blank(x)}, ',', ' ')") for x in ("address", "parsed_city", "state")) + " || ','")
CHECKS = """checks as (select component, 26 as max_age_hours from (select distinct component from runs) union all
 select component || '_nightly', 26 from (select distinct component from runs))"""
AGES = f"""ages as (select k.component, k.max_age_hours, l.last_finished_at,
 datesub('hour', l.last_finished_at, {NOW}) as age_hours from checks k left join
 (select component, max(finished_at) as last_finished_at from runs where status = 'success' group by component) l
 on l.component = k.component)"""

# ---- one statement per query ----

ORACLES: dict[str, str] = {
    "norm_addr": with_("stores") + f"""select store_id, {norm_addr(
        f"({blank('address')} || ' ' || {blank('parsed_city')} || ' ' || {blank('state')})")} as norm_addr from stores""",
    "norm_name": with_("stores", "accounts") + f"""select account_id, {norm_name('clean_name')} as norm_name from accounts
 union all select store_id, {norm_name('store_name')} from stores""",
    "name_key": with_("stores", "accounts") + f"""select id, {name_key('n')} as name_key from
 (select store_id as id, {norm_name('store_name')} as n from stores union all
  select account_id, {norm_name('clean_name')} from accounts)""",
    "cannabis_flag": with_("stores", "accounts") + f"""select store_id as id, {is_cannabis('store_name')} as is_cannabis
 from stores union all select account_id, {is_cannabis('clean_name')} from accounts""",
    "norm_city": with_("stores", "accounts") + f"""select store_id as id, {norm_city('parsed_city')} as norm_city from stores
 union all select account_id, {norm_city('city')} from accounts""",
    "house_num": with_("stores", "accounts") + f"""select id, {house_num(norm_addr("(a || ' ' || b || ' ' || d)"))} as house_num
 from (select store_id as id, {blank('address')} as a, {blank('parsed_city')} as b, {blank('state')} as d from stores union all
  select account_id, {blank('clean_address')}, {blank('city')}, {blank('state')} from accounts)""",
    "norm_id_field": with_("scrapes") + f"""select phone, {norm_id('store_name')} as name_id, {norm_id('road')} as road_id
 from scrapes""",
    "store_identity": with_("scrapes") + f"select phone, seen_at, {store_id()} as store_id from scrapes",
    "parse_bool": with_("scrapes") + f"select phone, is_chain, {parse_bool('is_chain')} as parsed from scrapes",
    "parse_float": with_("scrapes") + f"select phone, rating, {parse_float('rating')} as parsed from scrapes",
    "parse_int": with_("scrapes") + f"select phone, review_count, {parse_int('review_count')} as parsed from scrapes",
    "parse_text": with_("scrapes") + "select " + ", ".join(f"{parse_text(x)} as {x}" for x in (
        "brand", "store_name", "address", "phone", "email", "parsed_country", "parsed_city", "house_number", "road", "zip",
        "state", "chain_name")) + " from scrapes",
    "api_eligible": with_("stores") + f"""select store_id, state, upper({blank('state')}) in ({listed(tx.API_STATES)})
 as run_api from stores""",
    "similarity_ratio": with_("stores") + f"""select store_id, {ratio('n', 'b')} as name_to_brand,
 {ratio('n', 'a')} as name_to_address from
 (select store_id, lower(store_name) as n, lower(brand) as b, lower({blank('address')}) as a from stores)""",
    "similarity_of_long_texts": with_("stores") + f"""select store_id, length(a) as left_length, length(b) as right_length,
 {ratio('a', 'b', 'hugeint')} as score from (select store_id, lower(concat_ws(' ', store_name, brand, address, parsed_city,
 state, phone, road, parsed_country, zip)) as a, lower(concat_ws(' ', phone, brand, road, store_name, address, parsed_city,
 store_name, brand, address, state, store_name, road, phone)) as b from stores)""",
    "token_sort_ratio": with_("stores") + f"""select store_id, {ratio('n', 'b')} as score from (select store_id,
 {sorted_words('lower(store_name)')} as n, {sorted_words('lower(brand)')} as b from stores)""",
    "similar_city_pairs": with_("stores", "accounts") + f"""select * from (select a.state, store_city, account_city,
 {ratio('store_city', 'account_city')} as score from
 (select distinct {blank('state')} as state, {norm_city('parsed_city')} as store_city from stores) a join
 (select distinct {blank('state')} as state, {norm_city('city')} as account_city from accounts) b on a.state = b.state
 where store_city <> '' and account_city <> '') where score >= 86""",
    "similar_names_in_tiles": with_("stores", "accounts") + f"""select * from (select a.state, store_text,
 account_text, {ratio('store_text', 'account_text')} as score from
 (select distinct {blank('state')} as state, {norm_name('store_name')} as store_text from stores) a join
 (select distinct {blank('state')} as state, {norm_name('clean_name')} as account_text from accounts) b
 on a.state = b.state) where score >= 75""",
    "account_projection": with_("accounts") + f"""select distributor as distributor_name, account_id as source_id,
 original_name, clean_name as name, clean_address as address, {blank('city')} as city, {blank('state')} as state,
 {blank('zip_code')} as zip_code, cast(case_volume as double) as case_volume, cast(revenue as double) as revenue,
 cast(revenue_per_case as double) as revenue_per_case from accounts""",
    "candidate_projection": with_("stores") + f"""select store_id, {blank('store_name')} as name,
 {blank('address')} as address, {blank('parsed_city')} as city, {blank('state')} as state, {blank('zip')} as zip_code
 from stores""",
    "matcher_input_scan": with_("stores") + "select * from stores",
    "records_per_distributor": with_("accounts") + """select distributor as distributor_name, count(*) as records
 from accounts group by all""",
    "union_distributors": with_("accounts") + "select distributor, account_id, clean_name from accounts",
    "last_account_per_name": with_("accounts", *ACCOUNT_KEYS) + """select distributor_name, norm_name,
 max(source_id) as source_id from ac where norm_name <> '' group by all""",
    "stores_with_licences": with_("stores", "licences") + """select s.* replace (l.n as nj_abc_license_number)
 from stores s left join (select store_id, max(licence_number) as n from licences
 where store_id is not null group by store_id) l on l.store_id = s.store_id union all by name
 select 'nj-abc:' || licence_number as store_id, licensee as store_name, city as parsed_city, state,
 licence_number as nj_abc_license_number from licences
 where store_id is null or store_id not in (select store_id from stores)""",
    "match_exact_address": with_(*SIDES, L1) + f"select {HIT} from l1",
    "match_exact_name": with_(*SIDES, CITY_SCORES, L2) + f"select {HIT} from l2",
    "match_fuzzy_zip": with_(*SIDES, NAME_SCORES, L2B) + f"select {HIT} from l2b",
    "match_fuzzy_city": with_(*SIDES, CITY_SCORES, NAME_SCORES, CITY_PAIRS, state_layer("select * from city_pairs"))
    + f"select {HIT} from l3",
    "match_fuzzy_name_or_address": with_(*SIDES, NAME_SCORES, LOOSE_PAIRS, ADDRESS_SCORES, LOOSE_SCORED,
                                         state_layer("select * from loose_scored")) + f"select {HIT} from l3",
    "match_fuzzy_state": with_(*SIDES, *SCORES, CITY_PAIRS, LOOSE_SCORED, state_layer(BOTH)) + f"select {HIT} from l3",
    "match_wide_block": with_(
        f"stores as (select * replace ('NJ' as state, null as parsed_city) from ({STATEMENTS['stores']}))",
        f"accounts as (select * replace ('NJ' as state, null as city) from ({STATEMENTS['accounts']}))",
        *STORE_KEYS, *ACCOUNT_KEYS, NAME_SCORES, LOOSE_PAIRS, ADDRESS_SCORES, LOOSE_SCORED,
        state_layer("select * from loose_scored")) + f"select {HIT} from l3",
    "state_buckets": with_(*SIDES) + """select s.store_id, a.distributor_name, a.st = s.st as own_state,
 count(*) as accounts from st s join ac a on a.st = s.st or a.st = '' group by all""",
    "match_cascade": with_(*CASCADE) + "select * from flat",
    "distributor_match_arrays": with_(*CASCADE) + """select store_id, count(*) as entries,
 string_agg(distributor_name, ',' order by distributor_name) as distributors, bool_or(matched) as any_distributor_match
 from flat group by store_id""",
    "account_universe": with_(*CASCADE) + f"""select s.*, f.hit as any_distributor_match, null::varchar as place_id,
 null::double as lat, null::double as lng, {NOW} as matched_at, date '2024-01-31' as run_date,
 m.* exclude (store_id) from stores s join
 (select store_id, bool_or(matched) as hit from flat group by store_id) f on f.store_id = s.store_id
 join flat m on m.store_id = s.store_id""",
    "matched_with_revenue": with_(*CASCADE) + """select store_id, distributor_name, case_volume, revenue, revenue_per_case
 from flat where matched and revenue is not null""",
    "match_rollup": with_(*CASCADE) + """select distributor_name, match_layer, match_status, count(*) as stores,
 round(avg(match_confidence), 6) as mean_confidence, round(sum(revenue), 2) as revenue from flat where matched
 group by all""",
    "match_counts": with_(*CASCADE) + """select count(*) as processed, count(*) filter (where hit) as matched from
 (select store_id, bool_or(matched) as hit from flat group by store_id)""",
    "zero_match_check": with_("stores") + "select count(*) as processed, cast(0 as bigint) as matched from stores",
    "incremental_stores": with_("stores") + "select store_id from stores where not is_chain",
    "stores_to_process_count": with_("stores") + "select count(distinct store_id) as stores from stores where not is_chain",
    "incremental_match": with_(*CASCADE) + f"""select s.store_id, f.hit as any_distributor_match,
 case when s.is_chain then timestamp '2024-01-01 00:00:00' else {NOW} end as matched_at,
 case when s.is_chain then date '2024-01-01' else date '2024-01-31' end as run_date from stores s join
 (select store_id, bool_or(matched) as hit from flat group by store_id) f on f.store_id = s.store_id""",
    "full_match_run": with_(*CASCADE) + f"""select f.store_id, f.hit as any_distributor_match, {NOW} as matched_at,
 (select count(*) from stores where not is_chain) as rows_processed from stores s join
 (select store_id, bool_or(matched) as hit from flat group by store_id) f on f.store_id = s.store_id where not s.is_chain""",
    "normalized_listings": with_("scrapes", TYPED) + "select * from typed",
    "latest_scrape": with_("scrapes", TYPED, latest("one", "true", "ingested_at, source_file")) + "select * from one",
    "last_row_per_store": with_("scrapes", TYPED, latest("one", "true", "source_file").replace(
        "review_count desc nulls last", "review_count desc nulls last, ingested_at desc")) + "select * from one",
    "upsert": with_(*MERGE) + UPSERTED,
    "insert_only_merge": with_(*MERGE) + """select * from earlier union all
 select * from later where store_id not in (select store_id from earlier)""",
    "full_sync_merge": with_(*MERGE) + "select * from later",
    "full_sync_empty_source": with_(*MERGE) + "select * from earlier",
    "fill_missing_merge": with_("stores", *UPDATES) + """select s.store_id, s.address,
 case when u.store_id is not null then u.zip else s.zip end as zip,
 coalesce(case when s.address is null then 1.5::double end, u.lat) as lat, u.lng
 from stores s left join updates u on u.store_id = s.store_id""",
    "additive_columns": with_("scrapes", "licences") + """select phone, store_name, rating,
 null::varchar as nj_abc_license_number from scrapes union all select null, null, null, licence_number from licences""",
    "zip_lookup": with_(*ZIPS) + "select * from zips",
    "zip_file_load": with_(*ZIPS) + "select * from zips",
    "zip_file_without_density": with_("zip_raw") + f"""select case when length({strip('zip')}) < 5 then lpad({strip('zip')}, 5, '0')
 else {strip('zip')} end as zip, null::varchar as city, null::varchar as state, null::varchar as county,
 {parse_float('lat')} as latitude, {parse_float('lng')} as longitude, 0.0::double as pop_density_sqmi,
 0::bigint as population, 'rural' as area_type from zip_raw
 where {parse_float('lat')} is not null and {parse_float('lng')} is not null""",
    "area_type": with_("zip_raw") + f"select zip, {area('d')} as area_type from (select zip, {_DENSITY} as d from zip_raw)",
    "missing_coordinates": with_("stores", MART) + f"select store_id from mart where {MISSING}",
    "pending_geocode_requests": with_("stores", MART, *GEOCODES) + f"""select {REQUEST} from mart where {MISSING}
 and store_id not in (select store_id from geocodes)""",
    "first_geocode_requests": with_("stores", MART, *GEOCODES) + f"""select {REQUEST} from mart where {MISSING}
 and store_id not in (select store_id from geocodes) order by store_id limit 25""",
    "pending_geocode_count": with_("stores", MART, *GEOCODES) + f"""select count(*) as pending from mart where {MISSING}
 and store_id not in (select store_id from geocodes)""",
    "reply_zip": with_(*GEOCODES) + "select store_id, zip from classified",
    "classified_replies": with_(*GEOCODES) + "select * from classified",
    "geocode_sink": with_(*GEOCODES) + "select * from geocodes",
    "resumed_geocoding": with_("stores", MART, *GEOCODES) + f"""select {REQUEST} from mart where {MISSING}
 and store_id in (select store_id from classified where geocode_status = 'TRANSIENT')""",
    "failure_capture": with_("stores", MART) + f"""select 'store-geocoding' as component, 'unhandled_exception' as check_name,
 'infrastructure' as test_type, 'ERROR' as severity, cast(null as varchar) as context, true as told, true as raised,
 true as no_heartbeat, count(*) as pending from mart where {MISSING}""",
    "account_contract": with_("accounts") + """select 'revenue' as column_name, 'missing_column' as violation, 'double' as expected,
 cast(null as varchar) as found, count(*) as rows from accounts where distributor <> 'north_dist' union all
 select 'case_volume', 'wrong_type', 'double', 'string', count(*) from accounts where distributor <> 'north_dist'""",
    "geocode_summary": with_("stores", MART, *GEOCODES) + f"""select count(*) as pending, count(*) as processed,
 count(*) filter (where geocode_status = 'OK') as geocoded,
 count(*) filter (where geocode_status in ('ZERO_RESULTS', 'INVALID_REQUEST')) as unresolvable,
 count(*) filter (where geocode_status = 'TRANSIENT') as transient,
 count(*) filter (where geocode_status = 'TRANSIENT') as remaining
 from mart join classified using (store_id) where {MISSING}""",
    "unresolved_geocodes": with_(*GEOCODES) + "select store_id, geocode_status from geocodes where lat is null",
    "forgotten_geocodes": with_("licences", *GEOCODES) + """select store_id, geocode_status from geocodes g
 where not exists (select 1 from licences l where l.store_id = g.store_id)""",
    "located_stores": with_("stores", *GEOCODES, *ZIPS) + """select s.store_id, coalesce(s.zip, g.zip) as zip,
 coalesce(case when s.is_chain then 40.5::double end, g.lat, z.latitude) as latitude,
 coalesce(case when s.is_chain then -74.5::double end, g.lng, z.longitude) as longitude, z.pop_density_sqmi, z.area_type,
 z.county from stores s left join geocodes g on g.store_id = s.store_id
 left join zips z on z.zip = coalesce(s.zip, g.zip)""",
    "missing_zip_worklist": with_("stores") + """select store_id, address, parsed_city, state from stores
 where zip is null and address is not null order by store_id""",
    "batch_request_lines": with_("stores") + f"""select (row_number() over (order by store_id) - 1) // 100 as batch_id,
 store_id, {BATCH_LINE} as line from stores where zip is null and address is not null""",
    "batch_request_files": with_("stores") + f"""select (row_number() over (order by store_id) - 1) // 100 as batch_id,
 {BATCH_LINE} as line from stores""",
    "batch_reply_zip": with_("census_raw") + f"select store_id, {BATCH_ZIP} as zip from census_raw",
    "batch_reply_point": with_("census_raw") + f"select store_id, {POINT} from census_raw",
    "batch_reply_lines": with_(*UPDATES) + "select * from updates",
    "backfill_counts": with_("stores", *UPDATES) + """select count(u.store_id) as matched, count(*) as total from stores s
 left join updates u on u.store_id = s.store_id where s.zip is null and s.address is not null""",
    "scrape_file_scan": with_("scrapes", TYPED) + f"""select * replace ({NOW} as ingested_at,
 ['comma', 'tab', 'spaced', 'wide'][month(ingested_at) % 4 + 1] as source_file) from typed""",
    "ingest_then_backfill": with_("scrapes", LANDED, typed("landed"), *MERGE[2:], BACKFILLED)
    + "select store_id, address, zip, lat, lng from backfilled",
    "ingest_after_compaction": with_("scrapes", LANDED, typed("landed"), *MERGE[2:], BACKFILLED)
    + """select l.store_id, l.address, l.zip, b.lat, b.lng, l.rating from later l
 left join backfilled b on b.store_id = l.store_id union all select store_id, address, zip, lat, lng, rating
 from backfilled where store_id not in (select store_id from later)""",
    "scrape_ingest_stream": with_("scrapes", LANDED, typed("landed"), *MERGE[2:])
    + f"select * exclude (ingested_at, source_file) from ({UPSERTED})",
    "staged_snapshot": with_(*MERGE) + "select * from later",
    "last_success": with_("runs") + """select component, max(finished_at) as last_finished_at from runs
 where status = 'success' group by component""",
    "run_ages": with_("runs", CHECKS, AGES) + "select * from ages",
    "freshness_check": with_("runs", CHECKS, AGES) + """select component, case when age_hours is null
 then 'no_successful_run' else 'stale_run' end as check_name, age_hours, max_age_hours from ages
 where age_hours is null or age_hours > max_age_hours""",
    "monitor_run": with_("runs", CHECKS, AGES) + """select component, case when age_hours is null then 'no_successful_run'
 else 'stale_run' end as check_name, 'infrastructure' as test_type, '{"component":"' || component || '"' ||
 case when age_hours is null then '' else ',"age_hours":' || age_hours end || ',"max_age_hours":26}' as context
 from (select component, age_hours from ages where not ends_with(component, '_nightly') union all
  select 'job_unheard_of', null) where age_hours is null or age_hours > 26""",
    "elapsed_hours": with_("runs") + f"select run_id, datesub('hour', finished_at, {NOW}) as age_hours from runs",
    "run_stamps": with_("runs") + """select run_id, strftime(finished_at, '%Y%m%d_%H%M%S') as stamp,
 cast(finished_at as date) as run_date from runs""",
    "recent_errors": with_("errors") + f"""select occurred_at, component, check_name, severity, message from errors
 where occurred_at >= {NOW} - interval 24 hour order by occurred_at desc, component, check_name,
 severity, message limit 50""",
    "error_window_assertion": with_("errors") + f"""select error_id, occurred_at, component from errors
 where severity = 'ERROR' and occurred_at >= {NOW} - interval 48 hour""",
    "error_log_sink": with_("errors") + """select error_id, occurred_at, severity, context from errors
 where occurred_at >= timestamp '2024-01-20 00:00:00'""",
    "run_log_sink": with_("runs") + "select * from runs",
    "key_violations": with_("scrapes", TYPED) + """select store_id as key_value, count(*) as rows from typed group by all
 having count(*) > 1 or store_id is null""",
    "null_violations": with_("scrapes", TYPED) + """select * from (select 'ingested_at' as column_name,
 count(*) filter (where rating is null) as nulls from typed union all
 select 'source_file', count(*) filter (where zip is null) from typed) where nulls > 0""",
    "hex_ids": with_("runs") + """select run_id, 32 as length, true as is_hex, (select count(*) from runs) as different
 from runs""",
    "error_context_json": with_("runs") + """select run_id, '{"component":"' || component || '","rows_processed":' ||
 rows_processed || '}' as context from runs""",
}
