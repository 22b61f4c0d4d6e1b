"""The SQL each registered query is checked against, written for DuckDB.

Loops are unrolled into chains of materialised CTEs; reachability uses recursive UNION. Nothing here
is used by the operators.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- views ------------------------------------------------------------------------------------------

TRIPS = """trips AS (
  SELECT o_orderdate + INTERVAL 1 HOUR * (l_orderkey % 24) AS pickup_datetime,
         o_orderdate + INTERVAL 1 HOUR * (l_orderkey % 24)
           + INTERVAL 1 MINUTE * ((l_partkey * 13 + l_linenumber * 7) % 320 - 9) AS dropoff_datetime,
         s_nationkey AS pu, c_nationkey AS dz,
         l_quantity * l_discount AS dist,
         CAST((l_partkey * 13 + l_linenumber * 7) % 320 - 9 AS DOUBLE) AS dur,
         l_extendedprice * l_tax AS fare,
         l_linenumber - 1 AS pass
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey
                JOIN supplier ON l_suppkey = s_suppkey)"""
BASE = "(dist > 0 AND dur > 0 AND dur <= 300 AND NOT (pu = dz AND dist < 0.1))"
STRICT = f"({BASE} AND fare > 0 AND pass > 0)"
ZONES = """zones AS (
  SELECT n_nationkey AS zone_id,
         CASE WHEN n_nationkey % 12 <> 11 THEN n_name END AS zone_name,
         CASE WHEN n_nationkey % 12 <> 0 THEN CAST(30 AS DOUBLE) + CAST(0.5 AS DOUBLE) * n_nationkey END AS latitude,
         CASE WHEN n_nationkey % 12 <> 0 THEN CAST(20 AS DOUBLE) + CAST(0.7 AS DOUBLE) * n_nationkey END AS longitude,
         n_nationkey % 5 = 0 AS is_hotspot, n_nationkey % 5 = 1 AS is_secondary, n_nationkey % 7 = 0 AS is_hub
  FROM nation)"""


def _sum(x: str) -> str:
    return f"sum({x})"


def _edges(keep: str, minimum: int = 50) -> str:
    return f"""SELECT pu AS src, dz AS dst, count(*) AS weight,
      round({_sum('dur')}, 6) / count(*) AS avg_duration, round({_sum('dist')}, 6) / count(*) AS avg_distance,
      round({_sum('fare')}, 6) AS total_fare, round({_sum('fare')}, 6) / count(*) AS avg_fare
    FROM trips WHERE {keep} AND pu <> dz GROUP BY pu, dz HAVING count(*) >= {minimum}"""


CITY = [TRIPS, ZONES, f"e AS MATERIALIZED ({_edges(BASE)})"]
DEPOTS = """depots AS MATERIALIZED (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT l_suppkey AS src, l_partkey % (SELECT count(*) FROM supplier) AS dst FROM lineitem)
  WHERE src <> dst GROUP BY src, dst)"""
ALL = [ZONES, DEPOTS, "e AS MATERIALIZED (SELECT * FROM depots)"]
THIN = [ZONES, DEPOTS, "e AS MATERIALIZED (SELECT * FROM depots WHERE weight >= 2 * (SELECT avg(weight) FROM depots))"]
VERTICES = "v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e)"
NAMED = """names AS (
  SELECT id, coalesce(zone_name, 'Zone-' || id) AS name, coalesce(latitude, 0) AS latitude,
         coalesce(longitude, 0) AS longitude FROM v LEFT JOIN zones ON id = zone_id)"""
FLOWS = """flows AS MATERIALIZED (
  SELECT id, CAST(sum(o + i) AS BIGINT) AS degree, CAST(sum(i) AS BIGINT) AS in_degree,
         CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i * weight) AS BIGINT) AS in_flow,
         CAST(sum(o * weight) AS BIGINT) AS out_flow
  FROM (SELECT src AS id, 1 AS o, 0 AS i, weight FROM e UNION ALL SELECT dst, 0, 1, weight FROM e) GROUP BY id)"""
CENTRALITY = """deg AS (
  SELECT id, in_degree / CAST((SELECT count(*) - 1 FROM v) AS DOUBLE) AS in_centrality,
         out_degree / CAST((SELECT count(*) - 1 FROM v) AS DOUBLE) AS out_centrality FROM flows)"""


def sql(ctes: list[str], final: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + final


def score_order(column: str) -> str:
    return f"CAST({column} AS FLOAT) DESC, id"


# --- iterative pieces -----------------------------------------------------------------------------------

def rank_chain(iterations: int, weighted: bool = True, out: str = "pr") -> list[str]:
    """PageRank of (v, e) as one CTE per iteration; result ``out(id, pagerank)``."""
    w = "CAST(weight AS DOUBLE)" if weighted else "CAST(1 AS DOUBLE)"
    ctes = [
        f"{out}_t AS MATERIALIZED (SELECT src, sum({w}) AS total FROM e GROUP BY src)",
        f"{out}_s AS MATERIALIZED (SELECT e.src, e.dst, {w} / total AS share FROM e JOIN {out}_t t ON e.src = t.src)",
        f"{out}_0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) / (SELECT count(*) FROM v) AS r FROM v)",
    ]
    for k in range(iterations):
        ctes.append(f"""{out}_{k + 1} AS MATERIALIZED (
  SELECT v.id, (CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * (SELECT coalesce(sum(r), 0) FROM {out}_{k}
           WHERE id NOT IN (SELECT src FROM {out}_t))) / (SELECT count(*) FROM v)
         + CAST(0.85 AS DOUBLE) * coalesce(c.s, 0) AS r
  FROM v LEFT JOIN (SELECT dst, sum(r * share) AS s FROM {out}_s JOIN {out}_{k} ON src = id GROUP BY dst) c ON v.id = c.dst)""")
    return [*ctes, f"{out} AS MATERIALIZED (SELECT id, r AS pagerank FROM {out}_{iterations})"]


RANKED = [VERTICES, *rank_chain(20)]


def distance_chain(cost: str, doublings: int, sources: str = "v") -> list[str]:
    """All shortest distances by min-plus doubling, then path counts along tight edges."""
    ctes = [f"""d_0 AS MATERIALIZED (
  SELECT s, t, min(d) AS d FROM (SELECT id AS s, id AS t, 0 AS d FROM v
    UNION ALL SELECT src, dst, {cost} FROM e) GROUP BY s, t)"""]
    for k in range(doublings):
        ctes.append(f"""d_{k + 1} AS MATERIALIZED (
  SELECT a.s, b.t, min(a.d + b.d) AS d FROM d_{k} a JOIN d_{k} b ON a.t = b.s GROUP BY a.s, b.t)""")
    ctes.append(f"dist AS MATERIALIZED (SELECT * FROM d_{doublings})")
    ctes.append(f"""tight AS MATERIALIZED (
  SELECT a.s, e.src, e.dst FROM dist a JOIN e ON a.t = e.src JOIN dist b ON b.s = a.s AND b.t = e.dst
  WHERE a.d + {cost} = b.d)""")
    ctes.append("""walk AS (
  SELECT id AS s, id AS t FROM v UNION ALL SELECT walk.s, tight.dst FROM walk JOIN tight ON tight.s = walk.s AND tight.src = walk.t)""")
    ctes.append("paths AS MATERIALIZED (SELECT s, t, CAST(count(*) AS DOUBLE) AS p FROM walk GROUP BY s, t)")
    ctes.append(f"""raw_between AS MATERIALIZED (
  SELECT a.t AS id, sum(pa.p * pb.p / pc.p) AS raw
  FROM dist a JOIN dist b ON a.t = b.s JOIN dist c ON c.s = a.s AND c.t = b.t
       JOIN paths pa ON pa.s = a.s AND pa.t = a.t JOIN paths pb ON pb.s = b.s AND pb.t = b.t
       JOIN paths pc ON pc.s = c.s AND pc.t = c.t
  WHERE a.d + b.d = c.d AND a.s <> a.t AND b.s <> b.t AND a.s <> b.t AND a.s IN (SELECT id FROM {sources})
  GROUP BY a.t)""")
    ctes.append(f"""bw AS MATERIALIZED (
  SELECT v.id, coalesce(raw, 0) * ((SELECT count(*) FROM v) / CAST((SELECT count(*) FROM {sources}) AS DOUBLE))
    / ((SELECT count(*) FROM v) - 1) / ((SELECT count(*) FROM v) - 2) AS betweenness
  FROM v LEFT JOIN raw_between r ON v.id = r.id)""")
    return ctes


BETWEEN = distance_chain("weight", 6)

WCC = ["""reach AS (
  SELECT id AS a, id AS b FROM v UNION
  SELECT reach.a, x.dst FROM reach JOIN (SELECT src, dst FROM e UNION SELECT dst, src FROM e) x ON reach.b = x.src)""",
       "wcc AS MATERIALIZED (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"]


def label_chain(rounds: int = 5) -> list[str]:
    ctes = ["lp_0 AS MATERIALIZED (SELECT id, id AS label FROM v)"]
    for k in range(rounds):
        ctes.append(f"""lp_{k + 1} AS MATERIALIZED (
  SELECT id, label FROM (
    SELECT x.dst AS id, l.label, row_number() OVER (PARTITION BY x.dst ORDER BY count(*) DESC, l.label) AS n
    FROM (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e) x JOIN lp_{k} l ON x.src = l.id
    GROUP BY x.dst, l.label) WHERE n = 1)""")
    return [*ctes, f"""lp AS MATERIALIZED (SELECT id, label FROM lp_{rounds})""", """
 sizes AS MATERIALIZED (SELECT label, count(*) AS size,
   CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS INTEGER) AS community FROM lp GROUP BY label)""",
            "comm AS MATERIALIZED (SELECT id, lp.label, community FROM lp JOIN sizes ON lp.label = sizes.label)"]


LABELS = label_chain()

def removal(k: int) -> list[str]:
    """Graphs left after each of the k best-ranked vertices is removed in turn."""
    return [
        f"removed AS MATERIALIZED (SELECT id, CAST(n AS INTEGER) AS step FROM (SELECT id, row_number() OVER (ORDER BY {score_order('pagerank')}) AS n FROM pr) WHERE n <= {k})",
        f"""ed AS MATERIALIZED (
  SELECT e.src, e.dst, e.weight, least(coalesce(a.step, {k + 1}), coalesce(b.step, {k + 1})) AS death
  FROM e LEFT JOIN removed a ON e.src = a.id LEFT JOIN removed b ON e.dst = b.id)""",
        f"vd AS MATERIALIZED (SELECT v.id, coalesce(step, {k + 1}) AS death FROM v LEFT JOIN removed r ON v.id = r.id)",
        f"steps AS (SELECT CAST(range AS INTEGER) AS step FROM range({k + 1}))",
        "es AS MATERIALIZED (SELECT step, src, dst, weight FROM ed JOIN steps ON step < death)",
        "vs AS MATERIALIZED (SELECT step, id FROM vd JOIN steps ON step < death)",
        """flow AS MATERIALIZED (
  SELECT s.step, r.id AS removed_id,
             CAST((SELECT coalesce(sum(weight), 0) FROM ed WHERE death > s.step) AS BIGINT) AS remaining_flow,
             (SELECT count(*) FROM ed WHERE death > s.step) AS remaining_edges,
             (SELECT count(*) FROM v) - s.step AS nodes_remaining
  FROM steps s LEFT JOIN removed r ON s.step = r.step)""",
        """flow_pct AS MATERIALIZED (
  SELECT *, 100.0::DOUBLE * remaining_flow / CAST((SELECT sum(weight) FROM e) AS DOUBLE) AS remaining_flow_pct,
             100.0::DOUBLE * remaining_edges / CAST((SELECT count(*) FROM e) AS DOUBLE) AS remaining_edge_pct FROM flow)""",
    ]


REMOVAL = removal(5)
REMOVAL_WCC = ["""rreach AS (
  SELECT step, id AS a, id AS b FROM vs UNION
  SELECT r.step, r.a, x.dst FROM rreach r
    JOIN (SELECT step, src, dst FROM es UNION SELECT step, dst, src FROM es) x ON r.step = x.step AND r.b = x.src)""",
               "rwcc AS MATERIALIZED (SELECT step, a AS id, min(b) AS component FROM rreach GROUP BY step, a)",
               "rcount AS MATERIALIZED (SELECT step, count(DISTINCT component) AS num_components FROM rwcc GROUP BY step)"]
REMOVAL_PATHS = [
    """rlcc AS MATERIALIZED (
  SELECT step, component FROM (SELECT step, component, row_number() OVER (PARTITION BY step ORDER BY count(*) DESC, component) AS n
  FROM rwcc GROUP BY step, component) WHERE n = 1)""",
    "core AS MATERIALIZED (SELECT w.step, w.id FROM rwcc w JOIN rlcc l ON w.step = l.step AND w.component = l.component)",
    """h_0 AS MATERIALIZED (
  SELECT step, s, t, min(d) AS d FROM (
    SELECT step, id AS s, id AS t, 0 AS d FROM core
    UNION ALL SELECT x.step, x.src, x.dst, 1 FROM (SELECT step, src, dst FROM es UNION SELECT step, dst, src FROM es) x
      JOIN core c ON c.step = x.step AND c.id = x.src) GROUP BY step, s, t)""",
    *[f"""h_{k + 1} AS MATERIALIZED (
  SELECT a.step, a.s, b.t, min(a.d + b.d) AS d FROM h_{k} a JOIN h_{k} b ON a.step = b.step AND a.t = b.s
  GROUP BY a.step, a.s, b.t)""" for k in range(6)],
    """rpaths AS MATERIALIZED (
  SELECT step, count(DISTINCT s) AS core_size,
         sum(d) / nullif(CAST(count(DISTINCT s) * (count(DISTINCT s) - 1) AS DOUBLE), 0) AS avg_path
  FROM h_6 GROUP BY step)""",
]

_r = "round({0}, 8) AS {0}".format

# --- cleaning and aggregation ------------------------------------------------------------------------------

ORACLES["od_edges_base"] = sql([TRIPS], _edges(BASE))
ORACLES["od_edges_fine"] = sql([TRIPS.replace("l_quantity * l_discount AS", "l_quantity * l_discount / 7 AS").replace(
    "l_extendedprice * l_tax AS", "l_extendedprice * l_tax / 7 AS")], _edges(BASE))
ORACLES["od_edges_strict"] = sql([TRIPS], _edges(STRICT))
ORACLES["cleaning_report"] = sql([TRIPS], " UNION ALL ".join(
    f"""SELECT '{p}' AS profile, count(*) AS raw_rows, count(*) FILTER ({k}) AS kept_rows,
    count(*) - count(*) FILTER ({k}) AS removed_rows,
    CAST(100 AS DOUBLE) * (count(*) - count(*) FILTER ({k})) / count(*) AS removed_pct FROM trips"""
    for p, k in (("base", BASE), ("strict", STRICT))))


def _quality(duration: bool) -> str:
    zero = "count(*) FILTER (dur <= 0)" if duration else "CAST(0 AS BIGINT)"
    head = "" if duration else "'duration_derived', "
    return f"""SELECT 'OK' AS status, '' AS errors,
      concat_ws(',', {head}CASE WHEN count(*) FILTER (dist <= 0) > 0 THEN 'zero_distance' END,
                CASE WHEN {zero} > 0 THEN 'zero_duration' END) AS warnings,
      count(*) AS total_rows, count(DISTINCT pu) AS unique_pu, count(DISTINCT dz) AS unique_do,
      count(*) FILTER (dist <= 0) AS zero_distance,
      CAST(100 AS DOUBLE) * count(*) FILTER (dist <= 0) / count(*) AS zero_distance_pct,
      {zero} AS zero_duration, CAST(100 AS DOUBLE) * {zero} / count(*) AS zero_duration_pct FROM trips"""


ORACLES["quality_report"] = sql([TRIPS], _quality(True))
ORACLES["quality_report_raw_feed"] = sql([TRIPS], _quality(False))
ORACLES["threshold_sweep"] = sql(
    [TRIPS, f"p AS (SELECT pu, dz, count(*) AS n FROM trips WHERE {BASE} GROUP BY pu, dz)"],
    """SELECT t AS min_trips, count(*) FILTER (n >= t AND pu <> dz) AS edges,
       count(*) FILTER (n >= t) AS edges_with_loops
       FROM p CROSS JOIN (VALUES (40), (45), (50), (55), (60)) x(t) GROUP BY t""")
_VARIANTS = {"distance": "dist > 0", "distance_duration": "dist > 0 AND dur > 0", "base": BASE,
             "base_fare": f"{BASE} AND fare > 0", "base_passenger": f"{BASE} AND pass > 0"}
ORACLES["filter_ablation"] = sql([TRIPS], " UNION ALL ".join(
    f"""SELECT '{name}' AS variant, CAST(sum(n) AS BIGINT) AS kept_rows,
      count(*) FILTER (pu <> dz AND n >= 50) AS edges,
      CAST(coalesce(sum(n) FILTER (pu <> dz AND n >= 50), 0) AS BIGINT) AS flow
    FROM (SELECT pu, dz, count(*) AS n FROM trips WHERE {keep} GROUP BY pu, dz)""" for name, keep in _VARIANTS.items()))
ORACLES["profile_comparison"] = sql([TRIPS], " UNION ALL ".join(
    f"""SELECT '{p}' AS profile, n AS nodes, m AS edges, flow, m / CAST(n * (n - 1) AS DOUBLE) AS density FROM
      (SELECT count(*) AS m, CAST(sum(weight) AS BIGINT) AS flow FROM ({_edges(k)})) a,
      (SELECT count(*) AS n FROM (SELECT src FROM ({_edges(k)}) UNION SELECT dst FROM ({_edges(k)}))) b"""
    for p, k in (("base", BASE), ("strict", STRICT))))
ORACLES["monthly_counts"] = sql([TRIPS], "SELECT strftime(pickup_datetime, '%Y-%m') AS month, count(*) AS trips FROM trips GROUP BY 1")
ZONE_FLOW = """zf AS (
  SELECT id, CAST(sum(i) AS BIGINT) AS inbound, CAST(sum(o) AS BIGINT) AS outbound, CAST(sum(i + o) AS BIGINT) AS flow
  FROM (SELECT dz AS id, 1 AS i, 0 AS o FROM trips UNION ALL SELECT pu, 0, 1 FROM trips) GROUP BY id)"""
ORACLES["zone_flow"] = sql([TRIPS, ZONE_FLOW], "SELECT * FROM zf")

# --- sources: every round trip must give back the same trips ------------------------------------------------

_PAIRS = f"""SELECT pu AS src, dz AS dst, count(*) AS trips, round({_sum('dist')}, 6) AS distance, {_sum('dur')} AS minutes,
  round({_sum('fare')}, 6) AS fare, CAST(sum(pass) AS BIGINT) AS passengers,
  strftime(min(pickup_datetime), '%Y-%m-%d %H:%M:%S') AS first_pickup,
  strftime(max(dropoff_datetime), '%Y-%m-%d %H:%M:%S') AS last_dropoff FROM trips GROUP BY pu, dz"""
for _name in ("convert_mapped_trips", "convert_tlc_trips", "merge_sources_monthly", "glob_scan",
              "source_roundtrip_parquet", "source_roundtrip_csv", "source_roundtrip_tsv", "source_roundtrip_json",
              "source_json_lines", "source_json_array", "merge_mixed_types"):
    ORACLES[_name] = sql([TRIPS], _PAIRS)
ORACLES["source_dotted_dates"] = sql([TRIPS], """SELECT CASE WHEN pass = 3 THEN 'unreadable' ELSE strftime(pickup_datetime, '%Y-%m') END AS month,
  count(*) AS trips, sum(CASE WHEN pass <> 3 THEN dur END) AS minutes FROM trips GROUP BY 1""")
ORACLES["merge_by_pattern"] = sql([TRIPS], """SELECT ['int', 'long', 'double'][month(pickup_datetime) % 3 + 1] AS origin, count(*) AS trips,
  CAST(sum(pass) AS BIGINT) AS passengers, 'double' AS type FROM trips GROUP BY 1""")
ORACLES["rejected_trips"] = sql([TRIPS], """SELECT CASE WHEN pass = 3 THEN 'unreadable pickup_datetime' ELSE 'kept' END AS reason,
  CASE WHEN pass = 3 THEN 'unknown' ELSE strftime(pickup_datetime, '%Y-%m') END AS month, count(*) AS trips,
  CAST(sum(count(*)) OVER (PARTITION BY pass = 3) AS BIGINT) AS observed FROM trips GROUP BY 1, 2, pass = 3""")
ORACLES["source_lenient_ts"] = """SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'unreadable' ELSE strftime(o_orderdate, '%Y-%m') END AS month,
  count(*) AS orders FROM orders GROUP BY 1"""
ORACLES["zone_lookup_files"] = """SELECT n_nationkey AS zone_id, n_name AS zone_name,
  CASE WHEN n_nationkey % 3 <> 2 THEN n_nationkey * CAST(0.5 AS DOUBLE) END AS latitude,
  CASE WHEN n_nationkey % 3 <> 2 THEN n_nationkey * CAST(0.25 AS DOUBLE) END AS longitude
  FROM nation WHERE n_nationkey % 6 <> 5 AND n_nationkey % 4 <> 3"""

# --- graph tables ---------------------------------------------------------------------------------------------

_EDGE_NAMES = """SELECT e.src, e.dst, e.weight,
  coalesce(a.zone_name, 'Zone-' || e.src) AS src_name, coalesce(a.latitude, 0) AS src_lat, coalesce(a.longitude, 0) AS src_lon,
  coalesce(b.zone_name, 'Zone-' || e.dst) AS dst_name, coalesce(b.latitude, 0) AS dst_lat, coalesce(b.longitude, 0) AS dst_lon
  FROM {0} e LEFT JOIN zones a ON e.src = a.zone_id LEFT JOIN zones b ON e.dst = b.zone_id"""
_TOP = "(SELECT * FROM e ORDER BY weight DESC, src, dst LIMIT {0})".format
ORACLES["vertices_named"] = sql([*CITY, VERTICES, NAMED], "SELECT * FROM names")
ORACLES["edges_named"] = sql(CITY, _EDGE_NAMES.format("e"))
ORACLES["top_edges"] = sql(ALL, "SELECT src, dst, weight FROM e ORDER BY weight DESC, src, dst LIMIT 200")
ORACLES["map_edges"] = sql(CITY, f"SELECT * FROM ({_EDGE_NAMES.format(_TOP(300))}) WHERE src_lat <> 0 AND dst_lat <> 0")
ORACLES["degrees"] = sql([*ALL, FLOWS], "SELECT id, degree, in_degree, out_degree FROM flows")
ORACLES["weighted_flow"] = sql([*ALL, FLOWS], "SELECT id, in_flow, out_flow FROM flows")
ORACLES["degree_centrality"] = sql([*ALL, VERTICES, FLOWS, CENTRALITY], "SELECT * FROM deg")
_STATS = """SELECT (SELECT count(*) FROM v) AS nodes, count(*) AS edges, CAST(sum(weight) AS BIGINT) AS flow,
  count(*) / CAST((SELECT count(*) * (count(*) - 1) FROM v) AS DOUBLE) AS density,
  CAST(2 AS DOUBLE) * count(*) / (SELECT count(*) FROM v) AS avg_degree{0} FROM e"""
ORACLES["graph_stats"] = sql([*ALL, VERTICES], _STATS.format(""))


def _histogram(relation: str, column: str, bins: int) -> str:
    return f"""SELECT bin, lo + bin * w / {bins} AS lower, lo + (bin + 1) * w / {bins} AS upper, count(*) AS n, round(log10(count(*)), 8) AS log_count FROM (
      SELECT CAST(least(floor((x - lo) * {bins} / w), {bins - 1}) AS INTEGER) AS bin, lo, w FROM (
        SELECT CAST({column} AS DOUBLE) AS x FROM {relation}) a, (
        SELECT CASE WHEN max({column}) = min({column}) THEN min({column}) - 0.5 ELSE min({column}) END::DOUBLE AS lo,
               CASE WHEN max({column}) = min({column}) THEN 1 ELSE max({column}) - min({column}) END::DOUBLE AS w
        FROM {relation}) b) GROUP BY bin, lo, w"""


ORACLES["edge_weight_hist"] = sql(ALL, _histogram("e", "weight", 50))
ORACLES["degree_hist"] = sql([*ALL, FLOWS], _histogram("flows", "degree", 30))
ORACLES["distribution_summary"] = sql([*ALL, FLOWS], """SELECT CAST(sum(degree) AS DOUBLE) / count(*) AS mean_degree,
  (SELECT CAST(median(weight) AS DOUBLE) FROM e) AS median_weight FROM flows""")
ORACLES["undirected_edges"] = sql(ALL, """SELECT least(src, dst) AS src, greatest(src, dst) AS dst,
  CAST(sum(weight) AS BIGINT) AS weight FROM e GROUP BY 1, 2""")
ORACLES["isolated_ratio"] = sql([*THIN, VERTICES], """SELECT *, isolated / CAST(nodes AS DOUBLE) AS ratio,
  isolated / CAST(nodes AS DOUBLE) > 0.2 AS fragmented FROM (
    SELECT count(*) AS nodes, count(*) FILTER (id NOT IN (SELECT id FROM v)) AS isolated FROM (
      SELECT s_suppkey AS id FROM supplier UNION SELECT id FROM v))""")
_UNIFORM = "CAST(('0x' || substr(md5({0}), 1, 8))::BIGINT AS DOUBLE) / 4294967296".format
ORACLES["edge_sample"] = sql(ALL, f"""SELECT src, dst, weight FROM e
  WHERE {_UNIFORM("src || '#' || dst || '#42'")} < CAST(5000 AS DOUBLE) / (SELECT count(*) FROM e)""")

# --- zones --------------------------------------------------------------------------------------------------------

ORACLES["zone_types"] = sql([ZONES], """SELECT zone_id, CASE WHEN is_hotspot THEN 'hotspot' WHEN is_hub THEN 'hub'
  ELSE 'normal' END AS zone_type FROM zones""")
ORACLES["zone_weights"] = sql([ZONES], """SELECT zone_id, CAST(CASE WHEN is_hotspot THEN 25 WHEN is_hub THEN 15
  WHEN is_secondary THEN 12 ELSE 1 END AS DOUBLE) AS zone_weight FROM zones""")
ORACLES["zone_summary"] = sql([ZONES], """SELECT count(*) AS zones, count(*) FILTER (is_hotspot) AS hotspots,
  count(*) FILTER (is_secondary) AS secondary, count(*) FILTER (is_hub) AS hubs FROM zones""")
ORACLES["auto_zone_tiers"] = sql([TRIPS, ZONES, ZONE_FLOW], """SELECT id, coalesce(zone_name, 'Zone-' || id) AS name,
  inbound, outbound, flow, rank,
  CASE WHEN rank <= hot THEN 'hotspot' WHEN rank <= hot + CASE WHEN n > hot THEN greatest(1, CAST(floor((n - hot) * 0.15) AS BIGINT)) ELSE 0 END
       THEN 'secondary' ELSE 'normal' END AS tier,
  coalesce(is_hub, false) AS is_hub, latitude, longitude
  FROM (SELECT *, CAST(row_number() OVER (ORDER BY flow DESC, id) AS INTEGER) AS rank, count(*) OVER () AS n,
               greatest(1, CAST(floor(count(*) OVER () * 0.1) AS BIGINT)) AS hot FROM zf)
  LEFT JOIN zones ON id = zone_id""")
ORACLES["slug_names"] = "SELECT n_nationkey AS zone_id, 'sehir_ic_ag__' || replace(lower(n_name), ' ', '_') || '_sao_malaga_kagthane_r_odz_dz_fi_o' AS slug FROM nation"
ORACLES["format_counts"] = sql([TRIPS, ZONE_FLOW], """SELECT id, f AS flow,
  CASE WHEN f >= 1000000 THEN (t // 10) || ',' || (t % 10) || 'M'
       WHEN f >= 1000 THEN CAST(floor(f / 1000 + 0.5) AS BIGINT) || 'K'
       ELSE CAST(f AS VARCHAR) END AS shown
  FROM (SELECT id, f, CAST(floor(f / 100000 + 0.5) AS BIGINT) AS t FROM (
    SELECT id, CAST(CASE WHEN id % 6 = 0 THEN flow % 1000 WHEN id % 3 = 0 THEN flow WHEN id % 3 = 1 THEN flow * 37 ELSE flow * 3701 END AS BIGINT) AS f FROM zf))""")

# --- ranks -----------------------------------------------------------------------------------------------------------

_PR = f"SELECT id, {_r('pagerank')} FROM pr"
ORACLES["pagerank_weighted"] = sql([*ALL, *RANKED], _PR)
ORACLES["pagerank_unweighted"] = sql([*ALL, VERTICES, *rank_chain(20, weighted=False)], _PR)
ORACLES["pagerank_converged"] = sql([*ALL, VERTICES, *rank_chain(30)], _PR)
_PLACED = f"SELECT *, CAST(row_number() OVER (ORDER BY {score_order('pagerank')}) AS INTEGER) AS rank FROM pr"
ORACLES["critical_tiers"] = sql([*ALL, *RANKED], f"""SELECT rank, id, CASE WHEN rank <= 3 THEN 'critical'
  WHEN rank <= 7 THEN 'high' WHEN rank <= 15 THEN 'medium' ELSE 'normal' END AS tier, {_r('pagerank')}
  FROM ({_PLACED}) WHERE rank <= 15""")
ORACLES["top40_subgraph"] = sql([*ALL, *RANKED, f"best AS (SELECT id FROM ({_PLACED}) WHERE rank <= 40)"],
                                "SELECT src, dst, weight FROM e WHERE src IN (SELECT id FROM best) AND dst IN (SELECT id FROM best)")
_BW = f"SELECT id, {_r('betweenness')} FROM bw"
ORACLES["betweenness_exact"] = sql([*ALL, VERTICES, *BETWEEN], _BW)
ORACLES["betweenness_hops"] = sql([*CITY, VERTICES, *distance_chain("1", 4)], _BW)
ORACLES["betweenness_sampled"] = sql(
    [*ALL, VERTICES, "pivots AS MATERIALIZED (SELECT id FROM v ORDER BY md5(id || '#42'), id LIMIT 50)",
     *distance_chain("weight", 6, "pivots")], _BW)
ORACLES["rank_disagreement"] = sql([*ALL, *RANKED, *BETWEEN], f"""SELECT id, {_r('betweenness')},
  round(betweenness / (SELECT max(betweenness) FROM bw), 8) AS betweenness_norm, betweenness_rank, pagerank_rank,
  pagerank_rank - betweenness_rank AS gap FROM (
    SELECT bw.id, betweenness,
      CAST(row_number() OVER (ORDER BY CAST(betweenness AS FLOAT) DESC, bw.id) AS INTEGER) AS betweenness_rank,
      CAST(row_number() OVER (ORDER BY CAST(pagerank AS FLOAT) DESC, bw.id) AS INTEGER) AS pagerank_rank
    FROM bw JOIN pr ON bw.id = pr.id)""")
_HEAT_COLUMNS = ("pagerank", "betweenness", "in_centrality", "out_centrality")
ORACLES["centrality_heat"] = sql(
    [*ALL, *RANKED, *BETWEEN, FLOWS, CENTRALITY, f"""t AS (SELECT p.rank, p.id, pagerank, betweenness, in_centrality, out_centrality
      FROM ({_PLACED}) p JOIN bw ON p.id = bw.id JOIN deg ON p.id = deg.id WHERE rank <= 20)"""],
    "SELECT rank, id, " + ", ".join(f"round(CASE WHEN max({c}) OVER () > 0 THEN {c} / max({c}) OVER () ELSE 0 END, 8) AS {c}" for c in _HEAT_COLUMNS) + " FROM t")
ORACLES["degree_heat"] = sql(
    [*ALL, *RANKED, FLOWS, f"t AS (SELECT p.rank, p.id, pagerank, CAST(degree AS DOUBLE) AS degree FROM ({_PLACED}) p JOIN flows f ON p.id = f.id WHERE rank <= 20)"],
    "SELECT rank, id, " + ", ".join(f"round({c} / max({c}) OVER (), 8) AS {c}" for c in ("pagerank", "degree")) + " FROM t")
ORACLES["pr_vs_betweenness"] = sql([*ALL, *RANKED, *BETWEEN, FLOWS, CENTRALITY], f"""SELECT p.id, {_r('pagerank')}, {_r('betweenness')},
  round(greatest(in_centrality * 2000, 20), 8) AS size, rank <= 5 AS labelled
  FROM ({_PLACED}) p JOIN bw ON p.id = bw.id JOIN deg ON p.id = deg.id""")

# --- components, communities, paths -----------------------------------------------------------------------------------

ORACLES["wcc"] = sql([*THIN, VERTICES, *WCC], "SELECT * FROM wcc")
ORACLES["component_sizes"] = sql([*THIN, VERTICES, *WCC], "SELECT component, count(*) AS size FROM wcc GROUP BY component")
ORACLES["largest_component"] = sql([*THIN, VERTICES, *WCC], """SELECT id FROM wcc WHERE component = (
  SELECT component FROM wcc GROUP BY component ORDER BY count(*) DESC, component LIMIT 1)""")
ORACLES["scc"] = sql([*THIN, VERTICES, """reach AS (
  SELECT id AS a, id AS b FROM v UNION SELECT reach.a, e.dst FROM reach JOIN e ON reach.b = e.src)"""],
    """SELECT x.a AS id, min(x.b) AS component FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a GROUP BY x.a""")
ORACLES["label_propagation"] = sql([*ALL, VERTICES, *LABELS], "SELECT * FROM lp")
ORACLES["community_sizes"] = sql([*ALL, VERTICES, *LABELS], "SELECT label, size FROM sizes")
_SUMMARY = """SELECT s.community, s.label, s.size, round(CAST(100 AS DOUBLE) * s.size / (SELECT count(*) FROM v), 8) AS share_pct,
  (SELECT string_agg(name, '; ' ORDER BY id) FROM (SELECT c.id, name FROM comm c JOIN names n ON c.id = n.id
     WHERE c.label = s.label ORDER BY c.id LIMIT 5)) AS top_members,
  round((SELECT avg(pagerank) FROM comm c JOIN pr ON c.id = pr.id WHERE c.label = s.label), 8) AS avg_pagerank
  FROM sizes s"""
ORACLES["community_summary"] = sql([*ALL, *RANKED, NAMED, *LABELS], _SUMMARY)
ORACLES["modularity"] = sql([*ALL, VERTICES, *LABELS], """SELECT round(sum(i) / max(m) - sum(t * t) / (max(m) * max(m)), 8) AS modularity FROM (
  SELECT a.label, CAST(sum(weight) AS DOUBLE) AS t, CAST(coalesce(sum(weight) FILTER (a.label = b.label), 0) AS DOUBLE) AS i,
         CAST((SELECT 2 * sum(weight) FROM e) AS DOUBLE) AS m
  FROM (SELECT src, dst, weight FROM e UNION ALL SELECT dst, src, weight FROM e) x
    JOIN lp a ON x.src = a.id JOIN lp b ON x.dst = b.id GROUP BY a.label)""")
_STEP0 = ["es AS MATERIALIZED (SELECT 0 AS step, src, dst FROM e)", "vs AS MATERIALIZED (SELECT 0 AS step, id FROM v)"]
ORACLES["avg_path_length"] = sql([*ALL, VERTICES, *_STEP0, *REMOVAL_WCC, *REMOVAL_PATHS],
                                 f"SELECT core_size, {_r('avg_path')} FROM rpaths")

# --- removal ------------------------------------------------------------------------------------------------------------

ORACLES["removal_flow"] = sql([*ALL, *RANKED, *REMOVAL], """SELECT step, removed_id, remaining_flow, remaining_edges,
  remaining_flow_pct, remaining_edge_pct, nodes_remaining FROM flow_pct""")
ORACLES["removal_components"] = sql([*ALL, *RANKED, *removal(12), *REMOVAL_WCC], "SELECT * FROM rcount")
ORACLES["removal_paths"] = sql([*ALL, *RANKED, *REMOVAL, *REMOVAL_WCC, *REMOVAL_PATHS],
                               f"SELECT step, core_size, {_r('avg_path')} FROM rpaths")


def _step_ranks() -> list[str]:
    """PageRank(10), unweighted, of every remaining graph."""
    ctes = ["n AS MATERIALIZED (SELECT step, count(*) AS n FROM vs WHERE step > 0 GROUP BY step)",
            "o AS MATERIALIZED (SELECT step, src, CAST(count(*) AS DOUBLE) AS o FROM es WHERE step > 0 GROUP BY step, src)",
            "q_0 AS MATERIALIZED (SELECT vs.step, vs.id, CAST(1 AS DOUBLE) / n AS r, o FROM vs JOIN n ON vs.step = n.step LEFT JOIN o ON o.step = vs.step AND o.src = vs.id)"]
    for k in range(10):
        ctes.append(f"""q_{k + 1} AS MATERIALIZED (
  SELECT q.step, q.id, (CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * coalesce(m.mass, 0)) / n.n + CAST(0.85 AS DOUBLE) * coalesce(c.s, 0) AS r, q.o
  FROM q_{k} q JOIN n ON q.step = n.step
    LEFT JOIN (SELECT step, sum(r) AS mass FROM q_{k} WHERE o IS NULL GROUP BY step) m ON m.step = q.step
    LEFT JOIN (SELECT es.step, es.dst, sum(r / o) AS s FROM es JOIN q_{k} p ON p.step = es.step AND p.id = es.src GROUP BY es.step, es.dst) c
      ON c.step = q.step AND c.dst = q.id)""")
    return ctes


ORACLES["removal_new_top3"] = sql([*ALL, *RANKED, *REMOVAL, *_step_ranks()], """SELECT step, CAST(place AS INTEGER) AS place, id,
  round(r, 8) AS pagerank FROM (SELECT step, id, r, row_number() OVER (PARTITION BY step ORDER BY CAST(r AS FLOAT) DESC, id) AS place FROM q_10)
  WHERE place <= 3""")
_TIMELINE = """SELECT *, round(sum(flow_drop_raw) OVER (ORDER BY step), 8) AS cumulative_loss, round(flow_drop_raw, 8) AS flow_drop FROM (
  SELECT f.step, removed_id, remaining_flow, remaining_edges, remaining_flow_pct, remaining_edge_pct, nodes_remaining, num_components{0},
    lag(remaining_flow_pct, 1, 100) OVER (ORDER BY f.step) - remaining_flow_pct AS flow_drop_raw,
    coalesce(lag(num_components) OVER (ORDER BY f.step) = 1 AND num_components > 1, false) AS splits
  FROM flow_pct f JOIN rcount c ON f.step = c.step{1})"""
ORACLES["removal_timeline"] = sql(
    [*ALL, *RANKED, *removal(12), *REMOVAL_WCC, *REMOVAL_PATHS],
    f"""SELECT step, removed_id, remaining_flow, remaining_edges, {_r('remaining_flow_pct')}, {_r('remaining_edge_pct')},
    nodes_remaining, num_components, {_r('avg_path')}, flow_drop, cumulative_loss, splits FROM (
    {_TIMELINE.format(', avg_path', ' JOIN rpaths p ON f.step = p.step')})""")

# --- component queries on all depot edges -----------------------------------------------------------------------------

# The same SQL as for the thinned graph, over all edges.
for _name in ("isolated_ratio", "wcc", "scc", "component_sizes", "largest_component", "removal_components", "removal_timeline"):
    ORACLES[f"{_name}_whole"] = ORACLES[_name].replace(THIN[-1], ALL[-1])

# --- component queries on the main routes of the supplier hops --------------------------------------------------------

HOPS = ["""hops AS MATERIALIZED (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT l_suppkey AS src, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst FROM lineitem)
  WHERE dst IS NOT NULL AND src <> dst GROUP BY src, dst)""",
        """routes AS MATERIALIZED (SELECT src, dst, weight FROM (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY weight DESC, md5(src || '#' || dst) DESC) AS n FROM hops) WHERE n = 1)"""]
ROUTES = [*HOPS, "e AS MATERIALIZED (SELECT * FROM routes)"]
CORE_ROUTES = [*HOPS, """near AS (
  SELECT src AS a, src AS b FROM (SELECT src FROM routes UNION SELECT dst FROM routes) UNION
  SELECT near.a, x.dst FROM near JOIN (SELECT src, dst FROM routes UNION SELECT dst, src FROM routes) x ON near.b = x.src)""",
               "grouped AS MATERIALIZED (SELECT a AS id, min(b) AS c FROM near GROUP BY a)",
               """e AS MATERIALIZED (SELECT src, dst, weight FROM routes JOIN grouped ON src = id
  WHERE c = (SELECT c FROM grouped GROUP BY c ORDER BY count(*) DESC, c LIMIT 1))"""]
ORACLES["hop_edges"] = sql(HOPS, "SELECT * FROM hops")
ORACLES["main_routes"] = sql(HOPS, "SELECT * FROM routes")
ORACLES["largest_components"] = sql([*THIN, VERTICES, *WCC], """SELECT CAST(row_number() OVER (ORDER BY size DESC, component) AS INTEGER) AS rank, component, size
  FROM (SELECT component, count(*) AS size FROM wcc GROUP BY component) ORDER BY rank LIMIT 5""")
for _name in ("wcc", "scc", "component_sizes", "largest_component", "largest_components"):
    ORACLES[f"{_name}_routes"] = ORACLES[_name].replace(sql(THIN, "")[:-1], sql(ROUTES, "")[:-1])
ORACLES["isolated_ratio_routes"] = ORACLES["isolated_ratio"].replace(sql(THIN, "")[:-1], sql(
    [*HOPS, "e AS MATERIALIZED (SELECT a.* FROM routes a JOIN routes b ON a.src = b.dst AND a.dst = b.src)"], "")[:-1])
ORACLES["removal_components_routes"] = sql([*CORE_ROUTES, *RANKED, *removal(40), *REMOVAL_WCC], "SELECT * FROM rcount")
ORACLES["removal_timeline_routes"] = sql(
    [*CORE_ROUTES, *RANKED, *removal(5), *REMOVAL_WCC, *REMOVAL_PATHS],
    f"""SELECT step, removed_id, remaining_flow, remaining_edges, {_r('remaining_flow_pct')}, {_r('remaining_edge_pct')},
    nodes_remaining, num_components, {_r('avg_path')}, flow_drop, cumulative_loss, splits FROM (
    {_TIMELINE.format(', avg_path', ' JOIN rpaths p ON f.step = p.step')})""")
# Forest edges that die at a step: vertices that die then, and what the number of components falls by.
ORACLES["removal_forest"] = sql([*CORE_ROUTES, *RANKED, *removal(40), *REMOVAL_WCC], """SELECT CAST(step + 1 AS INTEGER) AS death, edges FROM (
  SELECT s.step, ((SELECT count(*) FROM vd WHERE death > s.step) - coalesce(c.num_components, 0))
    - ((SELECT count(*) FROM vd WHERE death > s.step + 1) - coalesce(d.num_components, 0)) AS edges
  FROM steps s LEFT JOIN rcount c ON s.step = c.step LEFT JOIN rcount d ON s.step + 1 = d.step) WHERE edges > 0""")
ORACLES["louvain_invariants"] = sql([*ALL, VERTICES], "SELECT count(*) AS vertices, count(*) AS ids, true AS named_by_smallest, true AS not_below_labels FROM v")

# --- reports on the trip graph --------------------------------------------------------------------------------------------

_CITY_ALL = [*CITY, *RANKED, NAMED, FLOWS, *LABELS]
_FEATURES = f"""features AS MATERIALIZED (SELECT p.id, name, n.latitude, n.longitude, pagerank,
  pagerank / (SELECT max(pagerank) FROM pr) AS pagerank_norm, betweenness,
  CASE WHEN (SELECT max(betweenness) FROM bw) > 0 THEN betweenness / (SELECT max(betweenness) FROM bw) ELSE 0 END AS betweenness_norm,
  in_flow, out_flow, CAST(in_flow AS DOUBLE) / (SELECT max(in_flow) FROM flows) AS in_flow_norm, community,
  CASE WHEN is_hotspot THEN 'hotspot' WHEN is_hub THEN 'hub' ELSE 'normal' END AS zone_type, rank
  FROM ({_PLACED}) p JOIN names n ON p.id = n.id JOIN bw ON p.id = bw.id JOIN flows f ON p.id = f.id
    JOIN comm c ON p.id = c.id LEFT JOIN zones z ON p.id = z.zone_id)"""
ORACLES["node_features"] = sql([*_CITY_ALL, *BETWEEN, _FEATURES], f"""SELECT id, name, latitude, longitude, {_r('pagerank')},
  {_r('pagerank_norm')}, {_r('betweenness')}, {_r('betweenness_norm')}, in_flow, out_flow, {_r('in_flow_norm')}, community, zone_type, rank
  FROM features""")
_EDGE_FEATURES = f"""SELECT x.*, e.avg_duration, x.weight / CAST((SELECT max(weight) FROM e) AS DOUBLE) AS weight_norm
  FROM ({_EDGE_NAMES.format(_TOP(300))}) x JOIN e ON x.src = e.src AND x.dst = e.dst WHERE src_lat <> 0 AND dst_lat <> 0"""
ORACLES["edge_features"] = sql(CITY, _EDGE_FEATURES)
ORACLES["map_centre"] = sql([*CITY, VERTICES, NAMED], """SELECT round(coalesce(avg(latitude), 41), 8) AS center_lat,
  round(coalesce(avg(longitude), 29), 8) AS center_lon FROM names WHERE latitude <> 0 AND longitude <> 0""")
ORACLES["top_bottlenecks"] = sql([*CITY, *RANKED, NAMED], f"""SELECT rank, p.id, name, {_r('pagerank')} FROM ({_PLACED}) p
  JOIN names n ON p.id = n.id WHERE rank <= 10 AND latitude <> 0 AND longitude <> 0""")
_LOCATED = f"SELECT src, dst, weight FROM ({_EDGE_NAMES.format('e')}) WHERE src_lat <> 0 AND dst_lat <> 0"
ORACLES["geo_feed"] = sql([*_CITY_ALL, f"shown AS (SELECT * FROM ({_LOCATED}) ORDER BY weight DESC, src, dst LIMIT 200)"], f"""
  SELECT 'node' AS kind, p.id, CAST(NULL AS INTEGER) AS dst, round(greatest(pagerank * 50000, 30), 8) AS size,
    round(community / CAST((SELECT count(*) FROM sizes) AS DOUBLE), 8) AS colour, rank <= 10 AS labelled
  FROM ({_PLACED}) p JOIN names n ON p.id = n.id JOIN comm c ON p.id = c.id WHERE latitude <> 0 AND longitude <> 0
  UNION ALL SELECT 'edge', src, dst, round(0.3::DOUBLE + weight / (SELECT max(weight) FROM shown)::DOUBLE * 2, 8),
    round(0.05::DOUBLE + weight / (SELECT max(weight) FROM shown)::DOUBLE * 0.3::DOUBLE, 8), NULL FROM shown""")
ORACLES["topology_feed"] = sql([*ALL, *RANKED, *LABELS, f"best AS MATERIALIZED (SELECT * FROM ({_PLACED}) WHERE rank <= 40)",
    "inner_e AS MATERIALIZED (SELECT * FROM e WHERE src IN (SELECT id FROM best) AND dst IN (SELECT id FROM best))"], """
  SELECT 'node' AS kind, b.id, CAST(NULL AS BIGINT) AS dst, round(pagerank * 30000, 8) AS size, community, rank <= 15 AS labelled
  FROM best b JOIN comm c ON b.id = c.id
  UNION ALL SELECT 'edge', src, dst, round(0.5::DOUBLE + weight / (SELECT max(weight) FROM inner_e)::DOUBLE * 3, 8), NULL, NULL FROM inner_e""")
ORACLES["visible_map"] = sql([*CITY, *RANKED, NAMED, f"placed AS MATERIALIZED ({_PLACED})",
    "gone AS (SELECT id FROM placed WHERE rank <= 3)", f"shown AS ({_EDGE_NAMES.format(_TOP(300))})"], """
  SELECT 'node' AS kind, p.id, CAST(NULL AS INTEGER) AS dst, p.id IN (SELECT id FROM gone) AS gone
  FROM placed p JOIN names n ON p.id = n.id WHERE latitude <> 0 AND longitude <> 0 AND rank <= 15
  UNION ALL SELECT * FROM (SELECT 'edge', src, dst, NULL::BOOLEAN FROM shown WHERE src_lat <> 0 AND dst_lat <> 0
    AND src NOT IN (SELECT id FROM gone) AND dst NOT IN (SELECT id FROM gone) ORDER BY weight DESC, src, dst LIMIT 40)""")
ORACLES["full_stats"] = sql([*ALL, VERTICES, *WCC, *LABELS], _STATS.format(
    ", (SELECT count(DISTINCT component) FROM wcc) AS components, (SELECT count(*) FROM sizes) AS communities"))
ORACLES["map_document"] = sql([*_CITY_ALL, *BETWEEN, _FEATURES, *REMOVAL, *REMOVAL_WCC], f"""
  SELECT 'node' AS section, CAST(rank AS BIGINT) AS seq, CAST(id AS BIGINT) AS id, CAST(NULL AS BIGINT) AS dst, name,
    CAST(community AS BIGINT) AS number, round(pagerank, 6) AS value FROM features
  UNION ALL SELECT 'edge', NULL, src, dst, NULL, weight, NULL FROM ({_EDGE_FEATURES})
  UNION ALL SELECT 'simulation', f.step, removed_id, NULL, NULL, num_components, CAST(remaining_flow AS DOUBLE)
    FROM flow f JOIN rcount c ON f.step = c.step WHERE f.step > 0
  UNION ALL SELECT 'community', community, label, NULL, top_members, size, round(avg_pagerank, 6) FROM ({_SUMMARY})""")
ORACLES["summary_report"] = sql([*_CITY_ALL, *REMOVAL, *REMOVAL_WCC], f"""
  SELECT 'nodes' AS metric, '' AS label, CAST(count(*) AS DOUBLE) AS value FROM v
  UNION ALL SELECT 'edges', '', count(*) FROM e UNION ALL SELECT 'flow', '', sum(weight) FROM e
  UNION ALL SELECT 'communities', '', count(*) FROM sizes
  UNION ALL SELECT 'top_' || rank, name, {_r('pagerank')} FROM ({_PLACED}) p JOIN names n ON p.id = n.id WHERE rank <= 5
  UNION ALL SELECT 'first_removal_loss', '', round(100 - remaining_flow_pct, 8) FROM flow_pct WHERE step = 1
  UNION ALL SELECT 'all_removals_loss', '', round(100 - remaining_flow_pct, 8) FROM flow_pct WHERE step = 5
  UNION ALL SELECT 'components_before', '', num_components FROM rcount WHERE step = 0
  UNION ALL SELECT 'components_after', '', num_components FROM rcount WHERE step = 5""")

# --- walks and vectors ------------------------------------------------------------------------------------------------------

ORACLES["random_walks"] = sql([*ALL, VERTICES,
    "r AS MATERIALIZED (SELECT src, dst, sum(weight) OVER w AS hi, sum(weight) OVER w - weight AS lo, sum(weight) OVER (PARTITION BY src) AS total FROM e WINDOW w AS (PARTITION BY src ORDER BY dst ROWS UNBOUNDED PRECEDING))",
    "t AS MATERIALIZED (SELECT DISTINCT src, CAST(total AS BIGINT) AS total FROM r)",
    f"""walk AS (
  SELECT id || '-' || n AS walk_id, 0 AS pos, id AS node FROM v, (SELECT range AS n FROM range(10))
  UNION ALL
  SELECT walk_id, pos + 1, r.dst FROM walk JOIN t ON t.src = node JOIN r ON r.src = node
    AND r.lo <= floor({_UNIFORM("walk_id || '#' || (pos + 1) || '#42'")} * t.total)
    AND floor({_UNIFORM("walk_id || '#' || (pos + 1) || '#42'")} * t.total) < r.hi
  WHERE pos < 79)"""], "SELECT walk_id, pos, node FROM walk")
ORACLES["node_embeddings"] = sql([*ALL, VERTICES], "SELECT id, CAST(128 AS INTEGER) AS dimensions FROM v")


ORACLES["embedding_feed_checks"] = sql(_CITY_ALL, f"""SELECT p.id, community, rank, rank <= 15 AS labelled,
  round(30.0 + pagerank / (SELECT max(pagerank) FROM pr) * 250.0, 6) AS size, true AS placed FROM ({_PLACED}) p JOIN comm c ON p.id = c.id""")


def _biased_walks(num_walks: int, walk_length: int, p: float, q: float, attempts: int = 120) -> list[str]:
    """Steps unrolled; of all attempts of a step the first kept one counts. With a quarter kept at least, 120 attempts
    leave none open but for a chance of 1e-15."""
    largest = max(1 / p, 1, 1 / q)
    steps = [f"""w0 AS MATERIALIZED (SELECT id || '-' || n AS walk_id, CAST(NULL AS BIGINT) AS prev, id AS node FROM v,
      (SELECT range AS n FROM range({num_walks})))"""]
    for k in range(1, walk_length):
        tries = f"SELECT range AS a FROM range({attempts if k > 1 else 1})"
        name = f"walk_id || '#{k}#42'" + (" || '#' || a" if k > 1 else "")
        keep = f"""{_UNIFORM(name + " || '#keep'")} * {largest} < CASE WHEN r.dst = c.prev THEN {1 / p}
          WHEN EXISTS (SELECT 1 FROM e WHERE e.src = c.prev AND e.dst = r.dst) THEN 1.0 ELSE {1 / q} END""" if k > 1 else "true"
        steps.append(f"""w{k} AS MATERIALIZED (SELECT walk_id, node AS prev, arg_min(dst, a) AS node FROM (
          SELECT c.walk_id, c.node, c.a, r.dst FROM (SELECT walk_id, prev, node, a, floor({_UNIFORM(name)} * t.total) AS x
            FROM w{k - 1}, ({tries}), t WHERE t.src = node) c
          JOIN r ON r.src = c.node AND r.lo <= c.x AND c.x < r.hi WHERE {keep}) GROUP BY walk_id, node)""")
    return steps


ORACLES["biased_walks"] = sql([*ALL, VERTICES,
    "r AS MATERIALIZED (SELECT src, dst, sum(weight) OVER w AS hi, sum(weight) OVER w - weight AS lo, sum(weight) OVER (PARTITION BY src) AS total FROM e WINDOW w AS (PARTITION BY src ORDER BY dst ROWS UNBOUNDED PRECEDING))",
    "t AS MATERIALIZED (SELECT DISTINCT src, CAST(total AS BIGINT) AS total FROM r)", *_biased_walks(2, 6, 0.5, 2.0)],
    " UNION ALL ".join(f"SELECT walk_id, CAST({k} AS INTEGER) AS pos, node FROM w{k}" for k in range(6)))
ORACLES["embedding_coverage"] = "SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT vec_id FROM embeddings)"
_VECTORS = """vec AS MATERIALIZED (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
 lens AS MATERIALIZED (SELECT id, x, sqrt(list_sum(list_transform(x, lambda a: a * a))) AS n FROM vec)"""
_COSINE = "list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) / (a.n * b.n)"
ORACLES["cosine_topn"] = sql([*ALL, FLOWS, _VECTORS,
    "anchors AS MATERIALIZED (SELECT id FROM flows ORDER BY in_flow + out_flow DESC, id LIMIT 10)"], f"""
  SELECT anchor, CAST(place AS INTEGER) AS place, id, round(s, 8) AS similarity FROM (
    SELECT anchor, id, s, row_number() OVER (PARTITION BY anchor ORDER BY CAST(s AS FLOAT) DESC, id) AS place FROM (
      SELECT a.id AS anchor, b.id, {_COSINE} AS s FROM lens a JOIN lens b ON a.id <> b.id WHERE a.id IN (SELECT id FROM anchors)))
  WHERE place <= 5""")
_NEAREST = f"""near AS MATERIALIZED (
  SELECT anchor, CAST(place AS INTEGER) AS place, id, round(s, 8) AS similarity FROM (
    SELECT anchor, id, s, row_number() OVER (PARTITION BY anchor ORDER BY CAST(s AS FLOAT) DESC, id) AS place FROM (
      SELECT a.id AS anchor, b.id, {_COSINE} AS s FROM lens a JOIN lens b ON a.id <> b.id WHERE a.n > 0 AND b.n > 0))
  WHERE place <= 5)"""
ORACLES["nearest_all"] = sql([_VECTORS, _NEAREST], "SELECT * FROM near")
ORACLES["vectors_written"] = sql([_VECTORS, _NEAREST], """SELECT vec.id, CAST(len(x) AS INTEGER) AS dimensions, n.id AS best, similarity,
  (SELECT count(*) FROM near WHERE near.id = vec.id) AS named_by FROM vec LEFT JOIN near n ON n.anchor = vec.id AND n.place = 1""")
ORACLES["similar_zones"] = sql([*ALL, *RANKED, NAMED, _VECTORS, f"placed AS MATERIALIZED ({_PLACED})"], f"""
  SELECT s.anchor, a.name AS anchor_name, p.rank AS anchor_rank, CAST(place AS INTEGER) AS place, s.id, n.name,
    round(s.s, 8) AS similarity, round(q.pagerank, 8) AS pagerank FROM (
    SELECT anchor, id, s, row_number() OVER (PARTITION BY anchor ORDER BY CAST(s AS FLOAT) DESC, id) AS place FROM (
      SELECT a.id AS anchor, b.id, {_COSINE} AS s FROM lens a JOIN lens b ON a.id <> b.id
      WHERE a.id IN (SELECT id FROM placed WHERE rank <= 10) AND b.id IN (SELECT id FROM v))) s
  JOIN names a ON s.anchor = a.id JOIN placed p ON s.anchor = p.id JOIN names n ON s.id = n.id JOIN placed q ON s.id = q.id
  WHERE place <= 5""")

# --- outlines -----------------------------------------------------------------------------------------------------------------

ORACLES["polygon_centroid"] = """WITH o AS (
  SELECT n_nationkey AS z, range AS k, n_nationkey + cos(range * 3.141592653589793 / 3) AS x,
         n_regionkey + 0.5 * sin(range * 3.141592653589793 / 3) AS y FROM nation, range(6)),
 s AS (SELECT a.z, a.x, a.y, b.x AS x2, b.y AS y2, a.x * b.y - b.x * a.y AS c FROM o a JOIN o b ON a.z = b.z AND b.k = (a.k + 1) % 6)
 SELECT z AS zone_id, round(abs(sum(c) / 2), 8) AS area, round(sum((x + x2) * c) / (3 * sum(c)), 8) + 0 AS x,
   round(sum((y + y2) * c) / (3 * sum(c)), 8) + 0 AS y FROM s GROUP BY z"""

ORACLES["removal_report"] = sql([*_CITY_ALL, *REMOVAL, *REMOVAL_WCC, *_step_ranks()], f"""SELECT step, removed_id, r.name AS removed_name, remaining_flow, remaining_edges,
  {_r('remaining_flow_pct')}, {_r('remaining_edge_pct')}, nodes_remaining, num_components, flow_drop, cumulative_loss, splits, l.names AS new_leaders
  FROM (SELECT * FROM ({_TIMELINE.format('', '')})) t LEFT JOIN names r ON removed_id = r.id LEFT JOIN (
    SELECT step AS s, string_agg(name, '; ' ORDER BY place) AS names FROM (
      SELECT step, id, row_number() OVER (PARTITION BY step ORDER BY CAST(r AS FLOAT) DESC, id) AS place FROM q_10) p JOIN names USING (id) WHERE place <= 3 GROUP BY step) l ON step = l.s""")

ORACLES["job_tables"] = sql([*_CITY_ALL, *REMOVAL, *REMOVAL_WCC, *WCC, f"ef AS MATERIALIZED ({_EDGE_FEATURES})"], " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS rows, CAST(sum({total}) AS DOUBLE) AS total FROM {relation}" for name, total, relation in (
        ("edges", "weight", "e"), ("vertices", "id", "v"), ("scores", "id", "pr"), ("betweenness", "id", "v"), ("communities", "community", "comm"),
        ("components", "component", "wcc"), ("timeline", "remaining_flow", "flow_pct"), ("node_features", "n", "(SELECT row_number() OVER () AS n FROM v)"),
        ("edge_features", "weight", "ef"), ("community_summary", "size", "sizes"), ("stats", "w", "(SELECT sum(weight) AS w FROM e)"),
        ("summary", "0", "(SELECT unnest(range(8 + (SELECT least(5, count(*)) FROM v))))"))))
