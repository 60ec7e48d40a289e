"""The same results as plain SQL over the given tables, for checking."""

from __future__ import annotations

import re
from collections.abc import Mapping

from ..operators.signs import BAND_ROWS, BANDS
from ..registry import FLAGS, MEASURES, PROJECTION_FEATURES, STATE_FEATURES
from .catalog import CUSTOMER_NAMES, DOCUMENT_COLUMNS, SIGN_BANDS, SIGN_ROWS, YEARS
from .views import VIEWS, view_sql

_PARTS: dict[str, str] = {name: view_sql(name) for name in VIEWS}


def _define(name: str, sql: str) -> None:
    _PARTS[name] = sql


def _any(words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"upper(imprv_det_type_desc) LIKE '%{w}%'" for w in words) + ")"


def _yes(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


_define("edges_dir", "SELECT a AS zone, b AS neighbour FROM zone_pairs UNION SELECT b, a FROM zone_pairs")
_define("pool", "SELECT zone, neighbour FROM edges_dir UNION SELECT zone, zone FROM edges_dir")
_define("imp", f"""
    SELECT prop_id, min(yr_built) AS yr_built,
      coalesce(sum(CASE WHEN {_any(('FLOOR',))} AND NOT isnan(imprv_det_area) THEN imprv_det_area END), 0) AS building_sqft,
      max({_yes(_any(('DECK', 'PORCH', 'TERRACE')))}) AS has_outdoor_space, max({_yes(_any(('GARAGE',)))}) AS has_garage,
      max({_yes(_any(('POOL',)))}) AS has_pool, max({_yes(_any(('HVAC',)))}) AS has_central_air,
      max({_yes(_any(('FIREPLACE',)))}) AS has_fireplace
    FROM improvements GROUP BY prop_id""")
_define("lnd", f"""
    SELECT prop_id, coalesce(sum(CASE WHEN NOT isnan(size_square_feet) THEN size_square_feet END), 0) AS land_sqft, max({_yes("land_type_desc LIKE '%Commercial%'")}) AS is_commercial,
      max({_yes("ag_apply = 'T'")}) AS is_ag FROM land GROUP BY prop_id""")
_define("mob", "SELECT DISTINCT prop_id, 1 AS is_mobile FROM mobile_homes")
_define("coded", f"""
    SELECT a.* EXCLUDE (py_addr_ml_deliverable, prop_type_cd, situs_unit), c.state_cd, c.ptd_state_cd_description,
      {_yes("py_addr_ml_deliverable = 'Y'")} AS is_deliverable, {_yes("prop_type_cd = 'R'")} AS is_residential,
      {_yes("situs_unit IS NOT NULL")} AS is_unit
    FROM appraisal a LEFT JOIN state_codes c ON a.imprv_state_cd = c.state_cd""")
_define("first_coded", f"""
    SELECT a.* EXCLUDE (py_addr_ml_deliverable, prop_type_cd, situs_unit, ingest_seq), c.state_cd, c.ptd_state_cd_description,
      {_yes("py_addr_ml_deliverable = 'Y'")} AS is_deliverable, {_yes("prop_type_cd = 'R'")} AS is_residential,
      {_yes("situs_unit IS NOT NULL")} AS is_unit
    FROM (SELECT * FROM appraisal_rows QUALIFY row_number() OVER (PARTITION BY prop_id ORDER BY ingest_seq) = 1) a
    LEFT JOIN state_codes c ON a.imprv_state_cd = c.state_cd""")
_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_HOT = ", ".join(f"{_yes(f'ptd_state_cd_description = {chr(39)}{v} Residence{chr(39)}')} AS {v.lower()}_residence" for v in _TYPES)
_define("feat", f"""
    SELECT c.*, {_HOT}, i.* EXCLUDE (prop_id), l.* EXCLUDE (prop_id), m.is_mobile
    FROM first_coded c LEFT JOIN imp i USING (prop_id) LEFT JOIN lnd l USING (prop_id) LEFT JOIN mob m USING (prop_id)""")
_define("listed", """
    SELECT CAST(id AS BIGINT) AS prop_id, address, TRY_CAST(regexp_replace(nullif(zestimate, 'None'), '[$,]', '', 'g') AS DOUBLE) AS zestimate,
      type_text AS type, TRY_CAST(CASE WHEN regexp_matches(yearbuilt_text, '^[0-9]+$') THEN yearbuilt_text END AS INTEGER) AS yearbuilt,
      TRY_CAST(replace(replace(floorsize_text, ' sqft', ''), ',', '') AS DOUBLE) AS floorsize, TRY_CAST(CASE WHEN regexp_matches(beds_text, '^[0-9.]+$') THEN beds_text END AS DOUBLE) AS beds,
      CASE len(regexp_extract_all(baths_text, '[0-9]'))
        WHEN 1 THEN CAST(regexp_extract_all(baths_text, '[0-9]')[1] AS DOUBLE)
        WHEN 2 THEN CAST(regexp_extract_all(baths_text, '[0-9]')[1] AS DOUBLE) + 0.5 * CAST(regexp_extract_all(baths_text, '[0-9]')[2] AS DOUBLE)
      END AS baths,
      CASE WHEN lower(flooring_text) LIKE '%hardwood%' THEN 1 ELSE 0 END AS has_hardwood,
      CASE WHEN lower(flooring_text) LIKE '%carpet%' THEN 1 ELSE 0 END AS has_carpet,
      CASE WHEN lower(flooring_text) LIKE '%tile%' THEN 1 ELSE 0 END AS has_tile, 1 AS listing
    FROM (SELECT * FROM listing_rows QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingest_seq) = 1) WHERE coalesce(zestimate, type_text, yearbuilt_text, floorsize_text, beds_text, baths_text, flooring_text) IS NOT NULL""")
_define("geo", """
    SELECT prop_id, Address AS geo_address, City, State, TRY_CAST(trim(Lat) AS DOUBLE) AS lat, TRY_CAST(trim(Long) AS DOUBLE) AS lon
    FROM geodata_rows QUALIFY row_number() OVER (PARTITION BY prop_id ORDER BY ingest_seq) = 1""")
_define("matrix", """
    SELECT g.*, f.* EXCLUDE (prop_id, geo_id, is_mobile), coalesce(f.is_mobile, 0) AS is_mobile,
      l.* EXCLUDE (prop_id, listing), coalesce(l.listing, 0) AS listing, replace(split_part(situs_zip, '-', 1), '.0', '') AS zone
    FROM geo g LEFT JOIN feat f USING (prop_id) LEFT JOIN listed l USING (prop_id)""")
_define("encoded", f"""
    SELECT prop_id, concat({", ".join(f"CAST(coalesce({f}, 0) AS STRING)" for f in FLAGS)}) AS hamming,
      {" + ".join(f"coalesce({f}, 0) * {1 << i}" for i, f in enumerate(FLAGS))} AS flag_bits FROM matrix""")


def _unit(value: str, low: str, high: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN CASE WHEN {high} > {low} THEN ({value} - {low}) / ({high} - {low}) ELSE 0 END END"


_define("scaled", f"""
    SELECT prop_id, zone, hood_cd, lat, lon, listing, flag_bits,
      {", ".join(_unit(f"CAST({m} AS DOUBLE)", f"CAST(min({m}) OVER () AS DOUBLE)", f"CAST(max({m}) OVER () AS DOUBLE)") + f" AS {m}" for m in MEASURES)}
    FROM matrix JOIN encoded USING (prop_id)""")

# Geodesic on WGS-84: fixed steps of the inverse iteration, one nested query per step.
_A, _F = 6378.137, 1 / 298.257223563
_B = _A * (1 - _F)


def vincenty_sql(source: str, steps: int = 7) -> str:
    """Adds ``km`` to ``source``, which has la1, lo1, la2, lo2."""
    sql = f"""
    SELECT *, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, radians(lo2 - lo1) AS gap, radians(lo2 - lo1) AS lam FROM (
      SELECT *, atan({1 - _F!r}::DOUBLE * tan(radians(la1))) AS u1, atan({1 - _F!r}::DOUBLE * tan(radians(la2))) AS u2 FROM {source})"""
    names = "sl, cl, ss, cs, sg, sa, c2a, mid, cc"
    for i in range(steps + 1):
        sql = f"SELECT *, sin(lam) AS sl, cos(lam) AS cl FROM ({sql})"
        sql = f"SELECT *, sqrt((c2*sl)*(c2*sl) + (c1*s2 - s1*c2*cl)*(c1*s2 - s1*c2*cl)) AS ss, s1*s2 + c1*c2*cl AS cs FROM ({sql})"
        sql = f"SELECT *, atan2(ss, cs) AS sg, CASE WHEN ss = 0 THEN 0 ELSE c1*c2*sl/ss END AS sa FROM ({sql})"
        sql = f"SELECT *, 1 - sa*sa AS c2a FROM ({sql})"
        sql = f"SELECT *, CASE WHEN c2a = 0 THEN 0 ELSE cs - 2*s1*s2/c2a END AS mid, {_F / 16!r}::DOUBLE*c2a*(4 + {_F!r}::DOUBLE*(4 - 3*c2a)) AS cc FROM ({sql})"
        if i < steps:
            sql = f"""SELECT * EXCLUDE ({names}, lam),
              gap + (1 - cc)*{_F!r}::DOUBLE*sa*(sg + cc*ss*(mid + cc*cs*(2*mid*mid - 1))) AS lam FROM ({sql})"""
    e2 = (_A * _A - _B * _B) / (_B * _B)
    sql = f"SELECT *, c2a*{e2!r}::DOUBLE AS uu FROM ({sql})"
    sql = f"""SELECT *, 1 + uu/16384*(4096 + uu*(-768 + uu*(320 - 175*uu))) AS ka, uu/1024*(256 + uu*(-128 + uu*(74 - 47*uu))) AS kb FROM ({sql})"""
    return f"""SELECT * EXCLUDE ({names}, lam, gap, u1, u2, s1, c1, s2, c2, uu, ka, kb),
      {_B!r}::DOUBLE*ka*(sg - kb*ss*(mid + kb/4*(cs*(2*mid*mid - 1) - kb/6*mid*(4*ss*ss - 3)*(4*mid*mid - 3)))) AS km FROM ({sql})"""


_define("pairs_raw", f"""
    SELECT a.prop_id AS search_prop, c.prop_id AS sim_prop, a.listing AS a_listing, a.lat AS la1, a.lon AS lo1, c.lat AS la2, c.lon AS lo2,
      bit_count(xor(a.flag_bits, c.flag_bits)) + CASE WHEN a.hood_cd = c.hood_cd THEN 0 ELSE 1 END AS ham,
      {", ".join(f"abs(coalesce(a.{m}, 0) - coalesce(c.{m}, 0)) AS g{i}" for i, m in enumerate(MEASURES))}
    FROM scaled a JOIN pool p ON a.zone = p.zone JOIN scaled c ON c.zone = p.neighbour WHERE a.prop_id <> c.prop_id""")
_define("pairs_km", vincenty_sql("pairs_raw"))
_W = "OVER (PARTITION BY search_prop)"
_define("pairs_ranged", f"""
    SELECT *, min(ham) {_W} AS ham_lo, max(ham) {_W} AS ham_hi, min(km) {_W} AS km_lo, max(km) {_W} AS km_hi FROM pairs_km""")
_define("pairs_scaled", f"""
    SELECT *, {_unit("ham", "ham_lo", "ham_hi")} AS ham_scaled, {_unit("km", "km_lo", "km_hi")} AS km_scaled,
      g0 + g1 + g2 + CASE WHEN a_listing = 1 THEN g3 + g4 + g5 + g6 ELSE 0 END AS absolute_diffs,
      g0*g0 + g1*g1 + g2*g2 + CASE WHEN a_listing = 1 THEN g3*g3 + g4*g4 + g5*g5 + g6*g6 ELSE 0 END AS squared_diffs
    FROM pairs_ranged""")
_define("pairs_scored", """
    SELECT *, sqrt(squared_diffs + ham_scaled*ham_scaled + km_scaled*km_scaled) AS euclidean, absolute_diffs + ham_scaled + km_scaled AS manhattan
    FROM pairs_scaled""")
for _m in ("euclidean", "manhattan"):
    _define(f"top_{_m}", f"""
        SELECT * FROM (SELECT *, {_m} AS sim_score, row_number() OVER (PARTITION BY search_prop ORDER BY round({_m}, 9) NULLS LAST, sim_prop) AS sim_rank,
          '{_m}' AS metric FROM pairs_scored) WHERE sim_rank <= 20""")

_define("wide", f"""
    SELECT prop_id, {", ".join(f"max(CASE WHEN prop_val_yr = {y} THEN appraised_val END) AS appraisal_{y}" for y in YEARS)}
    FROM (SELECT * FROM history_rows QUALIFY row_number() OVER (PARTITION BY prop_id, prop_val_yr ORDER BY ingest_seq) = 1) GROUP BY prop_id""")
_define("lists", """
    SELECT search_prop AS _id, string_agg(concat(sim_rank, ':', sim_prop), ',' ORDER BY sim_rank) AS "similar" FROM top_euclidean GROUP BY search_prop""")
_RAW = ", ".join(f"coalesce({f}::DOUBLE, -1)" if f not in STATE_FEATURES else "-1::DOUBLE" for f in PROJECTION_FEATURES)
_define("raw_planes", f"""
    SELECT p, list(('0x' || substr(md5(concat(i, '_', p)), 1, 8))::BIGINT / 4294967296::DOUBLE - 0.5 ORDER BY i) AS w
    FROM (SELECT unnest(range({len(PROJECTION_FEATURES)})) AS i), (SELECT unnest(range({BAND_ROWS * BANDS})) AS p) GROUP BY p""")
_define("raw_signs", f"""
    SELECT prop_id, zone, p // {BAND_ROWS} AS band, sum(CASE WHEN list_dot_product(v, w) > 0 THEN 1::BIGINT << (p % {BAND_ROWS})::INTEGER ELSE 0 END)::BIGINT AS signature
    FROM (SELECT prop_id, zone, [{_RAW}] AS v FROM matrix) JOIN raw_planes ON true GROUP BY prop_id, zone, p // {BAND_ROWS}""")
_define("top_lsh", """
    SELECT * FROM (SELECT a.prop_id AS search_prop, c.prop_id AS sim_prop, 1.0::DOUBLE AS sim_score,
        row_number() OVER (PARTITION BY a.prop_id ORDER BY count(*) DESC, c.prop_id) AS sim_rank, count(*) AS band_hits, 'lsh' AS metric
      FROM raw_signs a JOIN pool p ON a.zone = p.zone JOIN raw_signs c ON c.zone = p.neighbour AND a.band = c.band AND a.signature = c.signature
        AND a.prop_id <> c.prop_id GROUP BY a.prop_id, c.prop_id)
    WHERE sim_rank <= 20""")
_define("lists_all", " UNION ALL ".join(f"""
    SELECT search_prop AS _id, '{m}' AS metric, string_agg(concat(sim_rank, ':', sim_prop), ',' ORDER BY sim_rank) AS "similar" FROM top_{m} GROUP BY search_prop"""
    for m in ("euclidean", "manhattan", "lsh")))


def _whole(name: str) -> str:
    return f"coalesce(TRY_CAST(trunc({name}) AS BIGINT), 0) AS {name}"


def _upper(name: str) -> str:
    return f"upper(coalesce({name}, ' ')) AS {name}"


_define("docs", f"""
    SELECT m.prop_id AS _id, {", ".join(_upper(c) for c in ("address", "geo_address", "City", "State", "hood_cd", "situs_num", "type"))},
      coalesce(lat, 30.2672) AS Lat, lon AS Long, coalesce(TRY_CAST(trunc(appraised_val) AS BIGINT), 0) AS appraisal,
      {", ".join(_whole(c) for c in ("beds", "baths", "floorsize", "yr_built", "building_sqft", "land_sqft", "is_mobile", "has_pool", "zestimate"))},
      CAST(listing AS BIGINT) AS zillow, {", ".join(_whole(f"appraisal_{y}") for y in YEARS)}
    FROM matrix m LEFT JOIN wide h USING (prop_id)""")
_DOCS = ", ".join(DOCUMENT_COLUMNS)
_FOUND = f"""{_DOCS.replace(' address,', ' geo_address AS address,', 1)}, coalesce("similar", '') AS "similar" FROM docs LEFT JOIN lists USING (_id)"""

_define("sites", """
    SELECT l_partkey, l_suppkey, count(*) AS n_lines, any_value(lat) AS la1, any_value(lon) AS lo1,
      any_value(30::DOUBLE + s_nationkey * 0.15::DOUBLE) AS la2, any_value(-98::DOUBLE + s_nationkey * 0.05::DOUBLE) AS lo2
    FROM lineitem JOIN geo ON prop_id = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_partkey, l_suppkey""")
_define("sites_km", vincenty_sql("sites", 9))

_define("planes", f"""
    SELECT i, p, ('0x' || substr(md5(concat(i, '_', p)), 1, 8))::BIGINT / 4294967296::DOUBLE - 0.5 AS w
    FROM (SELECT unnest(range(64)) AS i), (SELECT unnest(range({SIGN_ROWS * SIGN_BANDS})) AS p)""")
_define("signs", f"""
    SELECT prop_id, p // {SIGN_ROWS} AS band, sum(CASE WHEN dot > 0 THEN 1 << (p % {SIGN_ROWS})::INTEGER ELSE 0 END)::BIGINT AS signature FROM (
      SELECT vec_id AS prop_id, p, sum(embedding[i + 1]::DOUBLE * w) AS dot FROM embeddings JOIN planes ON true GROUP BY vec_id, p)
    GROUP BY prop_id, p // {SIGN_ROWS}""")

# Shown texts: pages are split at '<', each part is a tag up to '>' and the text behind it; the open elements are kept tag by tag.
_define("page_parts", r"""
    SELECT page_id, i, tag, lower(regexp_extract(tag, '^/?([A-Za-z][^\s/]*)', 1)) AS name, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text FROM (
      SELECT page_id, i, CASE WHEN i > 1 THEN split_part(part, '>', 1) ELSE '' END AS tag, CASE WHEN i > 1 THEN substr(part, strpos(part, '>') + 1) ELSE part END AS text
      FROM (SELECT page_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM (
        SELECT page_id, string_split(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script.*?</script *>', '', 'g'),
          '(?is)<style.*?</style *>', '', 'g'), '<') AS parts FROM pages)))""")
_VOID = "'area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'source', 'track', 'wbr'"
_define("page_step", f"""
    SELECT page_id, i, text, name, CASE WHEN name = '' THEN 'none' WHEN tag LIKE '/%' THEN 'close' WHEN name IN ({_VOID}) OR tag LIKE '%/' THEN 'none' ELSE 'open' END AS kind,
      count(*) FILTER (text <> '') OVER (PARTITION BY page_id ORDER BY i) - CASE WHEN text <> '' THEN 1 ELSE 0 END AS seq,
      lag(text) OVER (PARTITION BY page_id, text = '' ORDER BY i) AS last
    FROM page_parts""")
_define("page_walk", """
    SELECT page_id, i, text, seq, last, [] :: STRUCT(name STRING, since BIGINT)[] AS stack FROM page_step WHERE i = 1
    UNION ALL
    SELECT s.page_id, s.i, s.text, s.seq, s.last, CASE kind WHEN 'open' THEN list_append(w.stack, {'name': s.name, 'since': s.seq})
      WHEN 'close' THEN CASE WHEN list_contains(list_transform(w.stack, lambda e: e.name), s.name)
        THEN w.stack[:len(w.stack) - list_position(list_reverse(list_transform(w.stack, lambda e: e.name)), s.name)] ELSE w.stack END
      ELSE w.stack END
    FROM page_walk w JOIN page_step s ON s.page_id = w.page_id AND s.i = w.i + 1""")
_define("page_text", """
    SELECT page_id, seq, coalesce(stack[-1].name, '') AS element, coalesce(stack[-2].name, '') AS above,
      CASE WHEN seq > coalesce(stack[-2].since, stack[-1].since, 0) THEN last END AS before, text AS child
    FROM page_walk WHERE text <> ''""")

# 'name' -> (columns and clauses, the parts it is built from are found by name)
_SELECTS: dict[str, str] = {
    "fixed_width_scan": f"SELECT {', '.join(CUSTOMER_NAMES)} FROM customer",
    "history_long": "SELECT prop_id, prop_val_yr, appraised_val FROM history_rows",
    "history_yearly": "SELECT prop_val_yr AS year, prop_id, prop_val_yr, appraised_val FROM history_rows WHERE prop_val_yr >= 1997",
    "csv_scan_typed": """SELECT CAST(prop_id AS STRING) AS prop_id, Address, City, State, trim(Lat) AS Lat, Long, geo_id, ingest_seq FROM geodata_rows""",
    "partition_by_zone": """
        SELECT prop_id, replace(split_part(situs_zip, '-', 1), '.0', '') AS zone, appraised_val FROM appraisal
        WHERE replace(split_part(situs_zip, '-', 1), '.0', '') IN ('78730', '78731', '78735', '78702', '78701', '78703', '78704', '78750', '78759',
          '78758', '78757', '78753', '78752', '78727', '78723', '78721', '78742', '78745', '78749', '78741', '78729', '78756', '78722')""",
    "listing_scan": """
        SELECT CAST(event_id AS STRING) AS id, concat(user_id, ' ', event_type) AS address,
          CASE WHEN event_type <> 'view' THEN concat('$', CAST(value AS STRING)) END AS zestimate,
          1 + CASE WHEN event_type IN ('click', 'error') THEN 1 ELSE 0 END AS n_facts,
          CASE WHEN event_type IN ('click', 'error') THEN event_type END AS type, CAST(props ->> '$.k' AS DOUBLE) AS beds FROM events""",
    "improvement_features": "SELECT * FROM imp",
    "land_features": "SELECT * FROM lnd",
    "code_join": "SELECT * FROM coded",
    "one_hot": f"SELECT prop_id, ptd_state_cd_description, {_HOT} FROM coded",
    "property_features": "SELECT * FROM feat",
    "listing_features": "SELECT * FROM listed",
    "feature_matrix": f"""
        SELECT prop_id, geo_address, City, State, lat, lon, zone, hood_cd, {", ".join(MEASURES)}, {", ".join(FLAGS)}, listing, zestimate, type, address
        FROM matrix""",
    "dedupe_first": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) = 1""",
    "hamming_encode": "SELECT prop_id, hamming, flag_bits FROM encoded",
    "minmax_scale": f"SELECT prop_id, {', '.join(f'round({m}, 6) AS {m}' for m in MEASURES)} FROM scaled",
    "clean_zone": "SELECT prop_id, situs_zip, replace(split_part(situs_zip, '-', 1), '.0', '') AS zone FROM appraisal",
    "zone_adjacency": "SELECT zone, neighbour FROM edges_dir",
    "zone_filter": """
        SELECT prop_id, replace(split_part(situs_zip, '-', 1), '.0', '') AS zone, hood_cd FROM appraisal
        WHERE replace(split_part(situs_zip, '-', 1), '.0', '') = '78704'""",
    "candidate_pool": """
        SELECT p.zone, max(a.n) AS searched, sum(c.n - CASE WHEN p.zone = p.neighbour THEN 1 ELSE 0 END)::BIGINT AS candidates, count(*) AS zones
        FROM pool p JOIN zone_sizes a ON a.zone = p.zone JOIN zone_sizes c ON c.zone = p.neighbour GROUP BY p.zone""",
    "candidate_pairs": """
        SELECT a.zone, c.zone AS neighbour, count(DISTINCT a.prop_id) AS searched, (count(*) / count(DISTINCT a.prop_id))::BIGINT AS candidates,
          count(*) AS pairs
        FROM zoned a JOIN pool p ON a.zone = p.zone JOIN zoned c ON c.zone = p.neighbour AND c.prop_id <> a.prop_id GROUP BY a.zone, c.zone""",
    "hamming_pairs": "SELECT search_prop, sim_prop, ham::BIGINT AS ham FROM top_euclidean",
    "pair_scale": """
        SELECT m.prop_id, m.zone, any_value(ham_lo)::BIGINT AS ham_lo, any_value(ham_hi)::BIGINT AS ham_hi, round(any_value(km_lo), 6) AS km_lo,
          round(any_value(km_hi), 6) AS km_hi
        FROM matrix m LEFT JOIN pairs_ranged r ON r.search_prop = m.prop_id GROUP BY m.prop_id, m.zone""",
    "pair_distance": """
        SELECT search_prop, sim_prop, ham::BIGINT AS ham, round(km, 6) AS km, round(ham_scaled, 6) AS ham_scaled, round(km_scaled, 6) AS km_scaled,
          round(squared_diffs, 6) AS squared_diffs, round(absolute_diffs, 6) AS absolute_diffs, round(euclidean, 6) AS euclidean,
          round(manhattan, 6) AS manhattan FROM top_euclidean""",
    "haversine_distance": """
        SELECT l_partkey, l_suppkey, n_lines, round(2 * 6371.0088::DOUBLE * asin(sqrt(least(1::DOUBLE, pow(sin(radians(la2 - la1) / 2), 2)
          + cos(radians(la1)) * cos(radians(la2)) * pow(sin(radians(lo2 - lo1) / 2), 2)))), 6) AS km FROM sites WHERE la1 IS NOT NULL
        UNION ALL SELECT l_partkey, l_suppkey, n_lines, NULL FROM sites WHERE la1 IS NULL""",
    "geodesic_distance": "SELECT l_partkey, l_suppkey, n_lines, round(km, 6) AS km FROM sites_km",
    **{f"top_k_{m}": f"SELECT search_prop, sim_prop, round(sim_score, 6) AS sim_score, sim_rank, metric FROM top_{m}" for m in ("euclidean", "manhattan")},
    "combine_scores": " UNION ALL ".join(f"""
        SELECT search_prop, sim_prop, round((max(sim_score) OVER () - sim_score) / (max(sim_score) OVER () - min(sim_score) OVER ()), 6) AS sim_score,
          sim_rank, metric FROM top_{m}""" for m in ("euclidean", "manhattan")) + " UNION ALL SELECT search_prop, sim_prop, sim_score, sim_rank, metric FROM top_lsh",
    "neighbour_list": 'SELECT _id, "similar" FROM lists',
    "incremental_score": " UNION ALL ".join(
        f"SELECT search_prop, sim_prop, round(sim_score, 6) AS sim_score, sim_rank, metric FROM top_{m}" for m in ("euclidean", "manhattan")),
    "score_ledger": """
        SELECT prop_id, 'euclidean' AS metric, count(search_prop) AS listed FROM matrix LEFT JOIN top_euclidean ON search_prop = prop_id WHERE zone IS NOT NULL GROUP BY prop_id""",
    "refresh_scores": " UNION ALL ".join(
        f"SELECT search_prop, sim_prop, round(sim_score, 6) AS sim_score, sim_rank, metric FROM top_{m}" for m in ("euclidean", "manhattan")),
    "random_baseline": """
        SELECT a.prop_id AS search_prop, c.prop_id AS sim_prop, round(u * pow(0.9::DOUBLE, k), 6) AS sim_score, k AS sim_rank
        FROM (SELECT prop_id, k, ('0x' || substr(md5(concat('0_', prop_id)), 1, 15))::BIGINT / pow(16::DOUBLE, 15) AS u,
            ('0x' || substr(md5(concat('0_', prop_id, '_', k)), 1, 15))::BIGINT % (SELECT count(*) FROM appraisal) AS at
          FROM appraisal, (SELECT unnest(range(1, 21)) AS k)) a
        JOIN (SELECT prop_id, row_number() OVER (ORDER BY prop_id) - 1 AS at FROM appraisal) c ON a.at = c.at""",
    "lsh_signature": "SELECT prop_id, band, signature FROM signs",
    "lsh_neighbours": """
        SELECT * FROM (SELECT a.prop_id AS search_prop, c.prop_id AS sim_prop, 1.0::DOUBLE AS sim_score,
            row_number() OVER (PARTITION BY a.prop_id ORDER BY count(*) DESC, c.prop_id) AS sim_rank, count(*) AS band_hits, 'lsh' AS metric
          FROM signs a JOIN signs c ON a.band = c.band AND a.signature = c.signature AND a.prop_id <> c.prop_id GROUP BY a.prop_id, c.prop_id)
        WHERE sim_rank <= 20""",
    "property_lsh": "SELECT search_prop, sim_prop, sim_score, sim_rank, metric, band_hits FROM top_lsh",
    "history_pivot": "SELECT * FROM wide",
    "publish_documents": f"""
        SELECT {_DOCS}, m.metric, coalesce("similar", '') AS "similar"
        FROM docs CROSS JOIN (SELECT unnest(['euclidean', 'manhattan', 'lsh']) AS metric) m LEFT JOIN lists_all l USING (_id, metric)""",
    "lookup_by_id": f"SELECT {_FOUND} WHERE _id = 42",
    "lookup_by_address": f"SELECT {_FOUND} WHERE geo_address = (SELECT upper(geo_address) FROM geo WHERE prop_id = 7) ORDER BY _id LIMIT 1",
    "lookup_contains": f"SELECT {_FOUND} WHERE contains(geo_address, 'BLUE GEAR') ORDER BY _id LIMIT 20",
    "lookup_by_ids": f"SELECT {_FOUND} WHERE _id IN (SELECT s_suppkey FROM supplier)",
    "neighbour_view": """
        SELECT search_id, _id, rank, geo_address, appraisal_2001, appraisal_1995, building_sqft, land_sqft
        FROM (SELECT prop_id AS search_id, prop_id AS _id, 0 AS rank FROM matrix UNION ALL SELECT search_prop, sim_prop, sim_rank FROM top_euclidean)
        JOIN docs USING (_id)""",
    "page_texts": "SELECT page_id, seq, element, above, before, child FROM page_text",
    "page_facts": r"""
        SELECT page_id, label, string_agg(lower(child), '|' ORDER BY seq) AS "values" FROM (
          SELECT page_id, seq, child, CASE WHEN suffix(before, ':') AND own <> '' THEN own ELSE lower(regexp_replace(replace('<' || element || '>' || chr(10) || child, child, ''), '[: \n]', '', 'g')) END AS label
          FROM (SELECT *, lower(regexp_replace(replace(before || chr(10) || child, child, ''), '[: \n]', '', 'g')) AS own FROM page_text))
        GROUP BY page_id, label""",
    "normalize_address": """
        SELECT prop_id, concat(trim(replace(replace(concat(situs_num, ' CONGRESS AVE TX ', situs_zip), 'TX', ''), situs_zip, '')), ' Austin, TX ', situs_zip)
          AS address FROM appraisal""",
    "geocode_match": """
        SELECT a.prop_id, a.address, coalesce(lat, 0) AS lat, coalesce(lng, 0) AS lng, edits FROM typed_addresses a LEFT JOIN (
          SELECT p_partkey AS prop_id, p_size * 1.5::DOUBLE AS lat, p_partkey * -0.5::DOUBLE AS lng,
            CASE p_type WHEN 'SMALL' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 0 END AS edits
          FROM part WHERE p_brand <> 'Brand#25' AND p_type NOT IN ('LARGE', 'PROMO')) USING (prop_id)""",
    "geocode_enrich": """
        SELECT n_name AS address, s_suppkey, CASE WHEN n_regionkey <> 3 THEN n_nationkey * 1.5::DOUBLE ELSE 0 END AS lat,
          CASE WHEN n_regionkey <> 3 THEN n_nationkey * -2.5::DOUBLE ELSE 0 END AS lng
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
}
_define("zoned", "SELECT prop_id, replace(split_part(situs_zip, '-', 1), '.0', '') AS zone FROM appraisal")
_define("zone_sizes", "SELECT zone, count(*) AS n FROM zoned GROUP BY zone")


_WALKS = {"page_walk"}  # parts that refer to themselves


def _needed(sql: str, parts: Mapping[str, str]) -> list[str]:
    """Parts a text refers to, in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        words = set(re.findall(r"\w+", text))
        for name in parts:
            if name in words and name not in order and name not in seen:
                seen.add(name)
                visit(parts[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, sql in (_SELECTS | {"listing_arrays": _SELECTS["listing_scan"]}).items():
        parts = _needed(sql, _PARTS)
        ctes = ",\n".join(f"{p} AS {'' if p in _WALKS else 'MATERIALIZED '}({_PARTS[p]})" for p in parts)
        result[name] = f"WITH {'RECURSIVE ' if _WALKS & {*parts} else ''}{ctes}\n{sql}" if parts else sql
    return result
