"""Fixture views as portable SQL (DuckDB side of the oracle).

The same inputs as ``stockmap.fixtures``, written as SQL so the oracle
queries are independent of the Spark code paths they check.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "f_zone": ((), """
SELECT (lpad(CAST((c_custkey * 7919) % 100000 AS VARCHAR), 5, '0') || CASE WHEN c_custkey < 100000 THEN '' ELSE '-' || CAST(c_custkey // 100000 AS VARCHAR) END) AS zip_code,
  CASE WHEN c_custkey % 101 <> 0 THEN 45.5 + CAST((c_custkey * 37) % 350 AS DOUBLE) / 100 END AS latitude,
  CASE WHEN c_custkey % 101 <> 0 THEN -124.5 + CAST((c_custkey * 91) % 760 AS DOUBLE) / 100 END AS longitude,
  CASE WHEN c_custkey % 97 <> 0 THEN CAST(c_nationkey * 500 + (c_custkey * 13) % 20000 AS BIGINT) END AS total_pop,
  CAST(20000 + (c_custkey * 1009) % 130000 AS BIGINT) AS median_income,
  CAST((c_custkey * 17) % 300 AS DOUBLE) / 10 AS poverty_rate
FROM customer"""),
    "f_site": ((), """
SELECT (lpad(CAST((s_suppkey * 6151) % 100000 AS VARCHAR), 5, '0') || CASE WHEN s_suppkey < 100000 THEN '' ELSE '-' || CAST(s_suppkey // 100000 AS VARCHAR) END) AS site_id,
  CASE WHEN s_suppkey % 10 = 0 THEN 'REGIONAL_HUB' WHEN s_suppkey % 10 <= 3 THEN 'DISTRIBUTION_CENTER'
       ELSE 'LOCAL_DISTRIBUTION' END AS site_type,
  45.5 + CAST((s_suppkey * 53) % 350 AS DOUBLE) / 100 AS latitude,
  -124.5 + CAST((s_suppkey * 113) % 760 AS DOUBLE) / 100 AS longitude,
  n_name AS city, CAST(10000 + (s_suppkey * 271) % 30000 AS BIGINT) AS pop
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "f_inv_level": ((), """
SELECT CASE WHEN l_partkey % 50 = 0 THEN 'UNKNOWN'
       ELSE (lpad(CAST((l_suppkey * 6151) % 100000 AS VARCHAR), 5, '0') || CASE WHEN l_suppkey < 100000 THEN '' ELSE '-' || CAST(l_suppkey // 100000 AS VARCHAR) END) END AS site_id,
  CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS BIGINT) AS on_hand_inventory,
  CAST(l_shipdate AS DATE) AS snapshot_date
FROM lineitem"""),
    "f_partner": ((), """
SELECT concat('SUP-', CAST(s_suppkey AS VARCHAR)) AS id, s_name AS name, 'SUPPLIER' AS partner_type, n_name AS city
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT concat('CUS-', CAST(c_custkey AS VARCHAR)), c_name, 'CUSTOMER', n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "f_customer": ((), """
SELECT concat('CUS-', CAST(c_custkey AS VARCHAR)) AS id, n_name AS city,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'HOSPITAL' ELSE 'CLINIC' END AS customer_type, c_custkey AS seq
FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "f_vendor": ((), """
SELECT concat('SUP-', CAST(s_suppkey AS VARCHAR)) AS id, s_suppkey AS seq,
  CAST(7 + s_suppkey % 8 AS INT) AS lead_time_days FROM supplier"""),
    "f_inbound_order": ((), """
SELECT CAST(o_orderkey AS VARCHAR) AS id, concat('CUS-', CAST(o_custkey AS VARCHAR)) AS tpartner_id,
  CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'IN_TRANSIT' ELSE 'PENDING' END AS order_status,
  CAST(o_orderdate AS DATE) AS order_date
FROM orders"""),
    "f_geography": ((), """
SELECT 'USA' AS id, CAST(NULL AS VARCHAR) AS parent_geo_id, 'country' AS level
UNION ALL SELECT concat('R-', r_name), 'USA', 'state' FROM region
UNION ALL SELECT concat('N-', n_name), concat('R-', r_name), 'metro' FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "f_product_group": ((), """
SELECT 'ALL' AS id, CAST(NULL AS VARCHAR) AS parent_product_group_id
UNION ALL SELECT DISTINCT p_type, 'ALL' FROM part
UNION ALL SELECT DISTINCT concat(p_type, '/', p_brand), p_type FROM part"""),
    "f_execution": ((), """
SELECT concat('s3-', CAST(user_id % 15 AS VARCHAR), '-flow') AS flow_name, event_id AS execution_id, ts AS start_time,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'RUNNING' WHEN 'signup' THEN 'QUEUED' ELSE 'SUCCEEDED' END AS status,
  CAST(round(value * 100) AS BIGINT) AS records_processed,
  CASE WHEN event_type = 'error' THEN CAST(event_id % 7 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS records_failed,
  CASE WHEN event_type <> 'click' THEN ts + to_seconds(event_id % 600) END AS end_time,
  CAST(CAST(round(value * 100) AS BIGINT) * 64 + event_id % 1000 AS BIGINT) AS bytes_processed
FROM events"""),
    "f_upsert": ((), """
SELECT concat('K', CAST(user_id AS VARCHAR)) AS id, ts AS event_ts, event_id AS seq, event_type AS status, value
FROM events"""),
    "f_stocks": (("f_inv_level", "f_site"), """
SELECT i.site_id, i.site_id AS zip_code, s.latitude, s.longitude, s.city, 'WA' AS state_prov,
  CAST(sum(i.on_hand_inventory) AS BIGINT) AS total_doses, count(i.product_id) AS product_count
FROM f_inv_level i LEFT JOIN f_site s ON i.site_id = s.site_id
WHERE s.site_id IS NOT NULL GROUP BY i.site_id, s.latitude, s.longitude, s.city"""),
    "f_pairs": (("f_zone", "f_stocks"), """
SELECT zip_code, latitude, longitude, total_pop, site_id, site_zip, total_doses,
  6371 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS distance_km
FROM (SELECT z.zip_code, z.latitude, z.longitude, z.total_pop, s.site_id, s.zip_code AS site_zip, s.total_doses,
    power(sin(radians(s.latitude - z.latitude) / 2), 2) + cos(radians(z.latitude)) * cos(radians(s.latitude))
      * power(sin(radians(s.longitude - z.longitude) / 2), 2) AS a
  FROM f_zone z CROSS JOIN f_stocks s WHERE z.latitude IS NOT NULL) p"""),
    "f_access": (("f_zone", "f_pairs"), """
SELECT z.zip_code, z.latitude, z.longitude, z.total_pop AS population, r.site_id AS nearest_site_id,
  r.site_zip AS nearest_site_zip, r.distance_km, r.distance_km * 0.621371 AS distance_miles, r.total_doses
FROM f_zone z LEFT JOIN
  (SELECT *, row_number() OVER (PARTITION BY zip_code, latitude, longitude ORDER BY distance_km, site_id) AS rn
   FROM f_pairs) r
  ON z.zip_code = r.zip_code AND z.latitude = r.latitude AND z.longitude = r.longitude AND r.rn = 1"""),
    "f_site_metrics": (("f_access",), """
SELECT nearest_site_id, CAST(sum(population) AS BIGINT) AS total_population_served,
  sum(CASE WHEN population IS NOT NULL THEN distance_km * population END)
    / NULLIF(CAST(sum(CASE WHEN distance_km IS NOT NULL THEN population END) AS DOUBLE), 0) AS pop_weighted_distance_km,
  count(zip_code) AS zip_codes_served, min(total_doses) AS total_doses,
  CAST(min(total_doses) AS DOUBLE) / NULLIF(CAST(sum(population) AS DOUBLE), 0) * 1000 AS doses_per_1000_people
FROM f_access WHERE nearest_site_id IS NOT NULL GROUP BY nearest_site_id"""),
    "f_sitegeo": (("f_site",), """
SELECT s.*, 'N-' || s.city AS geo_id FROM f_site s"""),
    "f_lane_edges": (("f_sitegeo",), """
SELECT kind, from_site_id, to_site_id, from_geo_id, to_geo_id, km FROM (
  SELECT kind, c.site_id AS to_site_id, c.geo_id AS to_geo_id, p.site_id AS from_site_id, p.geo_id AS from_geo_id,
    6371 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS km,
    row_number() OVER (PARTITION BY kind, c.site_id ORDER BY 6371 * 2 * atan2(sqrt(a), sqrt(1 - a)), p.site_id) AS rn
  FROM (SELECT k.kind, c.*, p.site_id AS psid,
          power(sin(radians(p.latitude - c.latitude) / 2), 2) + cos(radians(c.latitude)) * cos(radians(p.latitude))
            * power(sin(radians(p.longitude - c.longitude) / 2), 2) AS a
        FROM (VALUES ('hub_dc', 'DISTRIBUTION_CENTER', 'REGIONAL_HUB'),
                     ('dc_local', 'LOCAL_DISTRIBUTION', 'DISTRIBUTION_CENTER'),
                     ('dc_dc', 'DISTRIBUTION_CENTER', 'DISTRIBUTION_CENTER')) k(kind, ctype, ptype)
        JOIN f_sitegeo c ON c.site_type = k.ctype JOIN f_sitegeo p ON p.site_type = k.ptype
        WHERE k.kind <> 'dc_dc' OR p.site_id <> c.site_id) c
  JOIN f_sitegeo p ON p.site_id = c.psid) q WHERE rn = 1"""),
    "f_lanes": (("f_lane_edges",), """
SELECT concat_ws('-', 'LANE', from_site_id, to_site_id) AS id, from_site_id, to_site_id,
  'WA-PHARMA-DIST' AS connection_id, from_geo_id, to_geo_id, 'SCN_RESERVED_NO_VALUE_PROVIDED' AS carrier_tpartner_id,
  'TRUCK' AS trans_mode, 'STANDARD' AS service_type, 'SCN_RESERVED_NO_VALUE_PROVIDED' AS product_group_id,
  transit_time, 'DAY' AS time_uom, round(km * 0.621371, 1) AS distance, 'MI' AS distance_uom, cost_per_unit,
  DATE '1900-01-01' AS eff_start_date, DATE '9999-12-31' AS eff_end_date
FROM (
  SELECT from_site_id, to_site_id, from_geo_id, to_geo_id, km, CAST(1.0 AS DOUBLE) AS transit_time, CAST(0.50 AS DOUBLE) AS cost_per_unit
  FROM f_lane_edges WHERE kind = 'hub_dc'
  UNION ALL
  SELECT from_site_id, to_site_id, from_geo_id, to_geo_id, km, 0.5, 0.25 FROM f_lane_edges WHERE kind = 'dc_local'
  UNION ALL
  SELECT from_site_id, to_site_id, any_value(from_geo_id), any_value(to_geo_id), min(km), 1.5, 0.75 FROM (
    SELECT from_site_id, to_site_id, from_geo_id, to_geo_id, km FROM f_lane_edges WHERE kind = 'dc_dc'
    UNION ALL
    SELECT to_site_id, from_site_id, to_geo_id, from_geo_id, km FROM f_lane_edges WHERE kind = 'dc_dc') u
  GROUP BY from_site_id, to_site_id) l"""),
    "f_site_dim": (("f_sitegeo",), """
SELECT site_id AS id, 'WA-PHARMA-DIST' AS connection_id,
  city || ' ' || array_to_string(list_transform(string_split(lower(replace(site_type, '_', ' ')), ' '),
                                               lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')
       || ' - ZIP ' || site_id AS description,
  site_type, geo_id, latitude, longitude, city, 'WA' AS state_prov, site_id AS postal_code, 'US' AS country
FROM f_sitegeo"""),
    "f_geo_dim": (("f_geography",), """
SELECT id, 'WA-PHARMA-DIST' AS connection_id,
  CASE WHEN level = 'metro' THEN substr(id, 3) || ' Metro Area' ELSE id END AS description, parent_geo_id,
  'US' AS country, CASE WHEN level <> 'country' THEN 'WA' END AS state_prov,
  CASE WHEN level = 'metro' THEN substr(id, 3) END AS city
FROM f_geography"""),
    "f_inv_event": (("f_inv_level",), """
SELECT snapshot_date, site_id, product_id, on_hand_inventory, 'HEALTHY' AS inv_condition,
  'LOT-' || product_id || '-' || site_id || '-' || strftime(snapshot_date, '%Y%m%d') AS lot_number,
  CAST(snapshot_date + INTERVAL 365 DAY AS DATE) AS expiry_date
FROM f_inv_level"""),
    "f_policy": (("f_site",), """
SELECT 'POLICY-' || site_id || '-ANTIVIR' AS id, site_id, 'ANTIVIR-WA-01' AS product_id, 'WA-PHARMA-DIST' AS connection_id,
  'SCN_RESERVED_NO_VALUE_PROVIDED' AS product_group_id, 'SCN_RESERVED_NO_VALUE_PROVIDED' AS dest_geo_id,
  'SCN_RESERVED_NO_VALUE_PROVIDED' AS vendor_tpartner_id, 'abs_level' AS ss_policy,
  CAST(CASE site_type WHEN 'REGIONAL_HUB' THEN 2000 WHEN 'DISTRIBUTION_CENTER' THEN 500 ELSE 100 END AS BIGINT) AS min_safety_stock,
  CAST(CASE site_type WHEN 'REGIONAL_HUB' THEN 10000 WHEN 'DISTRIBUTION_CENTER' THEN 3000 ELSE 1000 END AS BIGINT) AS max_safety_stock,
  CAST(CASE site_type WHEN 'REGIONAL_HUB' THEN 5000 WHEN 'DISTRIBUTION_CENTER' THEN 1500 ELSE 500 END AS BIGINT) AS target_inventory_qty,
  CAST(CASE site_type WHEN 'REGIONAL_HUB' THEN 1000 WHEN 'DISTRIBUTION_CENTER' THEN 500 ELSE 100 END AS BIGINT) AS min_order_qty,
  CAST(CASE site_type WHEN 'REGIONAL_HUB' THEN 10000 WHEN 'DISTRIBUTION_CENTER' THEN 5000 ELSE 2000 END AS BIGINT) AS max_order_qty,
  DATE '1900-01-01' AS eff_start_date, DATE '9999-12-31' AS eff_end_date
FROM f_site WHERE site_type IN ('REGIONAL_HUB', 'DISTRIBUTION_CENTER', 'LOCAL_DISTRIBUTION')"""),
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            add(dep)
        order.append(n)

    for n in names:
        add(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in order)
    body = body.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
