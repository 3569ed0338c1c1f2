"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark code: fixture views are CTEs
(``stockmap.testing.views``), nearest site is an all-pairs ``row_number``.
Float outputs are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from stockmap.testing.views import with_views as W

ORACLE: dict[str, str] = {}


def sql(name: str, body: str, *views: str) -> None:
    ORACLE[name] = W(body, *views)


sql("current_stocks", "SELECT * FROM f_stocks", "f_stocks")

sql("orphan_stock", """
SELECT i.site_id, CAST(sum(i.on_hand_inventory) AS BIGINT) AS total_doses, count(i.product_id) AS product_count
FROM f_inv_level i WHERE NOT EXISTS (SELECT 1 FROM f_site s WHERE s.site_id = i.site_id)
GROUP BY i.site_id""", "f_inv_level", "f_site")

sql("access_by_zip", """
SELECT zip_code, latitude, longitude, population, nearest_site_id, nearest_site_zip,
  round(distance_km, 6) AS distance_km, round(distance_miles, 6) AS distance_miles, total_doses
FROM f_access""", "f_access")

sql("access_by_site", """
SELECT m.nearest_site_id, m.total_population_served, round(m.pop_weighted_distance_km, 6) AS pop_weighted_distance_km,
  m.zip_codes_served, m.total_doses, round(m.doses_per_1000_people, 6) AS doses_per_1000_people,
  s.site_id, s.zip_code, s.latitude, s.longitude, s.city, s.state_prov
FROM f_site_metrics m LEFT JOIN f_stocks s ON m.nearest_site_id = s.site_id""", "f_site_metrics", "f_stocks")

ALL_PREFIXES = "('75','76','77','78','79','90','91','92','93','94','95','96','32','33','34','10','11','12','13','14','98','99')"

sql("zip_prefix_filter", f"""
SELECT zip_code, latitude, longitude, total_pop FROM f_zone WHERE substr(zip_code, 1, 2) IN {ALL_PREFIXES}""",
    "f_zone")

sql("zip_centroids", """
SELECT zip_code, latitude, longitude FROM f_zone WHERE substr(zip_code, 1, 2) IN ('98','99','10','11','12','13','14')""",
    "f_zone")

sql("coerce_numeric", """
SELECT zcta, TRY_CAST(DP05_0001E AS DOUBLE) AS DP05_0001E, TRY_CAST(DP03_0062E AS DOUBLE) AS DP03_0062E,
  TRY_CAST(DP03_0128PE AS DOUBLE) AS DP03_0128PE
FROM (SELECT zip_code AS zcta, COALESCE(CAST(total_pop AS VARCHAR), '-') AS DP05_0001E,
  CAST(median_income AS VARCHAR) AS DP03_0062E, CAST(poverty_rate AS VARCHAR) AS DP03_0128PE FROM f_zone)""", "f_zone")

_ZIP_POP = f"""
SELECT zip_code, latitude, longitude, CAST(total_pop AS DOUBLE) AS total_pop, CAST(median_income AS DOUBLE) AS median_income,
  poverty_rate
FROM f_zone WHERE substr(zip_code, 1, 2) IN {ALL_PREFIXES}"""
sql("zip_population", _ZIP_POP, "f_zone")
sql("json_matrix_scan", _ZIP_POP, "f_zone")
sql("json_matrix_files", _ZIP_POP, "f_zone")

sql("gazetteer_scan", f"""
SELECT zip_code, latitude, longitude FROM f_zone WHERE substr(zip_code, 1, 2) IN {ALL_PREFIXES}""", "f_zone")

sql("cached_raw", """
SELECT zip_code AS zcta, COALESCE(CAST(total_pop AS VARCHAR), '-') AS DP05_0001E,
  CAST(median_income AS VARCHAR) AS DP03_0062E, CAST(poverty_rate AS VARCHAR) AS DP03_0128PE FROM f_zone""", "f_zone")

sql("stock_summary", """
SELECT count(*) AS sites, CAST(sum(total_doses) AS BIGINT) AS total_doses, round(avg(total_doses), 6) AS mean_doses,
  min(total_doses) AS min_doses, max(total_doses) AS max_doses FROM f_stocks""", "f_stocks")

sql("coverage_summary", """
SELECT count(*) AS zip_codes, CAST(sum(population) AS BIGINT) AS total_population,
  round(avg(distance_miles), 6) AS mean_distance_miles, round(max(distance_miles), 6) AS max_distance_miles
FROM f_access""", "f_access")

sql("site_summary", """
SELECT count(*) AS sites, CAST(sum(total_doses) AS BIGINT) AS total_doses,
  round(avg(total_population_served), 6) AS mean_population_served,
  round(avg(doses_per_1000_people), 6) AS mean_doses_per_1000 FROM f_site_metrics""", "f_site_metrics")

_METRICS_FULL = """
SELECT m.nearest_site_id, m.total_population_served, round(m.pop_weighted_distance_km, 6) AS pop_weighted_distance_km,
  m.zip_codes_served, m.total_doses, round(m.doses_per_1000_people, 6) AS doses_per_1000_people,
  s.site_id, s.zip_code, s.latitude, s.longitude, s.city, s.state_prov, m.doses_per_1000_people AS raw_ratio
FROM f_site_metrics m LEFT JOIN f_stocks s ON m.nearest_site_id = s.site_id"""

sql("best_stocked", f"""
SELECT * EXCLUDE (raw_ratio), CAST(row_number() OVER (ORDER BY raw_ratio DESC NULLS LAST, nearest_site_id) AS INTEGER) AS rank
FROM ({_METRICS_FULL}) q ORDER BY raw_ratio DESC NULLS LAST, nearest_site_id LIMIT 10""", "f_site_metrics", "f_stocks")

sql("most_understocked", f"""
SELECT * EXCLUDE (raw_ratio), CAST(row_number() OVER (ORDER BY raw_ratio ASC NULLS LAST, nearest_site_id) AS INTEGER) AS rank
FROM ({_METRICS_FULL}) q ORDER BY raw_ratio ASC NULLS LAST, nearest_site_id LIMIT 10""", "f_site_metrics", "f_stocks")

sql("stock_class", """
SELECT nearest_site_id, round(doses_per_1000_people, 6) AS doses_per_1000_people,
  CASE WHEN doses_per_1000_people > 100 THEN 'WELL_STOCKED' WHEN doses_per_1000_people < 50 THEN 'UNDERSTOCKED'
       WHEN doses_per_1000_people IS NOT NULL THEN 'BETWEEN' END AS stock_class
FROM f_site_metrics""", "f_site_metrics")

sql("coverage_gaps", """
SELECT zip_code, latitude, longitude, population, nearest_site_id, round(distance_km, 6) AS distance_km,
  CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'NO_LOCATION' WHEN distance_km IS NULL THEN 'NO_SITE'
       ELSE 'TOO_FAR' END AS gap_reason
FROM f_access WHERE distance_km IS NULL OR distance_km > 30""", "f_access")

sql("restock_priority", """
SELECT nearest_site_id, total_population_served, total_doses, round(need, 6) AS restock_need,
  row_number() OVER (ORDER BY need DESC, nearest_site_id) AS priority
FROM (SELECT *, greatest(0.0, 100.0 * total_population_served / 1000 - COALESCE(total_doses, 0)) AS need
      FROM f_site_metrics) q""", "f_site_metrics")

for _name, _col in (("equity_by_income", "median_income"), ("equity_by_poverty", "poverty_rate")):
    sql(_name, f"""
WITH cuts AS (SELECT quantile_disc({_col}, [0.25, 0.5, 0.75]) AS q FROM (
        SELECT a.*, z.{_col} FROM f_access a LEFT JOIN f_zone z USING (zip_code))),
banded AS (
  SELECT a.*, CASE WHEN z.{_col} IS NULL THEN NULL WHEN z.{_col} <= c.q[1] THEN 1 WHEN z.{_col} <= c.q[2] THEN 2
                   WHEN z.{_col} <= c.q[3] THEN 3 ELSE 4 END AS band
  FROM f_access a LEFT JOIN f_zone z USING (zip_code) CROSS JOIN cuts c)
SELECT CAST(band AS INTEGER) AS band, count(zip_code) AS zip_codes, CAST(sum(population) AS BIGINT) AS population,
  round(sum(CASE WHEN population IS NOT NULL THEN distance_km * population END)
        / NULLIF(CAST(sum(CASE WHEN distance_km IS NOT NULL THEN population END) AS DOUBLE), 0), 6) AS pop_weighted_distance_km
FROM banded WHERE band IS NOT NULL GROUP BY band""", "f_access", "f_zone")

sql("transshipment_pairs", """
WITH bal AS (
  SELECT m.nearest_site_id AS sid, s.latitude, s.longitude,
         m.total_doses - 75.0 * m.total_population_served / 1000 AS balance
  FROM f_site_metrics m JOIN f_stocks s ON m.nearest_site_id = s.site_id),
pairs AS (
  SELECT r.sid AS receiver_site_id, -r.balance AS receiver_deficit, d.sid AS donor_site_id, d.balance AS donor_surplus,
    6371 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS distance_km
  FROM (SELECT r.*, d.sid AS dsid, power(sin(radians(d.latitude - r.latitude) / 2), 2)
          + cos(radians(r.latitude)) * cos(radians(d.latitude)) * power(sin(radians(d.longitude - r.longitude) / 2), 2) AS a
        FROM bal r CROSS JOIN bal d WHERE r.balance < 0 AND d.balance > 0) r
  JOIN bal d ON d.sid = r.dsid),
best AS (SELECT *, row_number() OVER (PARTITION BY receiver_site_id ORDER BY distance_km, donor_site_id) AS rn FROM pairs)
SELECT receiver_site_id, round(receiver_deficit, 6) AS receiver_deficit, donor_site_id,
  round(donor_surplus, 6) AS donor_surplus, round(distance_km, 6) AS distance_km,
  round(least(receiver_deficit, donor_surplus), 6) AS transfer_qty
FROM best WHERE rn = 1 AND distance_km <= 250""", "f_site_metrics", "f_stocks")


# All pairs one after the other, closest first; needs and surpluses are lists that every step rewrites.
sql("transshipment_allocation", """
WITH RECURSIVE bal AS (
  SELECT m.nearest_site_id AS sid, s.latitude AS la, s.longitude AS lo, m.total_doses - 75.0 * m.total_population_served / 1000 AS gap
  FROM f_site_metrics m JOIN f_stocks s ON m.nearest_site_id = s.site_id),
r AS (SELECT sid, la, lo, CAST(ceil(-gap) AS BIGINT) AS need, row_number() OVER (ORDER BY sid) AS i FROM bal WHERE ceil(-gap) > 0),
d AS (SELECT sid, la, lo, CAST(floor(gap) AS BIGINT) AS surplus, row_number() OVER (ORDER BY sid) AS i FROM bal WHERE floor(gap) > 0),
a AS (SELECT r.sid AS rid, d.sid AS did, r.i AS ri, d.i AS di, r.need, d.surplus,
        power(sin(radians(d.la - r.la) / 2), 2) + cos(radians(r.la)) * cos(radians(d.la)) * power(sin(radians(d.lo - r.lo) / 2), 2) AS a
      FROM r CROSS JOIN d),
p AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY km, rid, did) AS n
      FROM (SELECT *, round(6371 * 2 * atan2(sqrt(a), sqrt(1 - a)), 6) AS km FROM a) WHERE km <= 250),
g AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS q, (SELECT list(need ORDER BY i) FROM r) AS needs, (SELECT list(surplus ORDER BY i) FROM d) AS gives
  UNION ALL
  SELECT p.n, least(g.needs[p.ri], g.gives[p.di]),
    list_concat(list_concat(g.needs[1:p.ri - 1], [g.needs[p.ri] - least(g.needs[p.ri], g.gives[p.di])]), g.needs[p.ri + 1:]),
    list_concat(list_concat(g.gives[1:p.di - 1], [g.gives[p.di] - least(g.needs[p.ri], g.gives[p.di])]), g.gives[p.di + 1:])
  FROM g JOIN p ON p.n = g.n + 1)
SELECT rid AS receiver_site_id, did AS donor_site_id, km AS distance_km, q AS quantity, need AS receiver_need, surplus AS donor_surplus
FROM g JOIN p USING (n) WHERE q > 0""", "f_site_metrics", "f_stocks")


# ---------------------------------------------------------------- supply tables

def jobj(*pairs: tuple[str, str]) -> str:
    """JSON object text with null members omitted (the shape Spark's to_json gives)."""
    parts = [f"CASE WHEN ({e}) IS NOT NULL THEN '\"{k}\":' || to_json({e}) END" for k, e in pairs]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


_CAL = """
WITH days AS (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
  FROM orders),
c AS (SELECT d, isodow(d) >= 6 AS weekend,
        CASE WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas' WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year' END AS hname
      FROM days)
"""
sql("calendar_dim", _CAL + """
SELECT 'CAL-' || strftime(d, '%Y%m%d') AS calendar_id, 'WA-PHARMA-DIST' AS connection_id,
  strftime(d, '%Y-%m-%d') || 'T00:00:00Z' AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day,
  CASE WHEN weekend OR hname IS NOT NULL THEN 'N' ELSE 'Y' END AS is_working,
  CASE WHEN hname IS NOT NULL THEN 'Y' ELSE 'N' END AS is_holiday,
  '1900-01-01T00:00:00Z' AS eff_start_date, '9999-12-31T23:59:59Z' AS eff_end_date
FROM c""")

sql("calendar_plain", _CAL + """
SELECT 'CAL-' || strftime(d, '%Y%m%d') AS id, d AS calendar_date, strftime(d, '%A') AS day_of_week,
  weekend AS is_weekend, hname IS NOT NULL AS is_holiday, hname AS holiday_name,
  NOT (weekend OR hname IS NOT NULL) AS is_working_day, CAST(year(d) AS INTEGER) AS fiscal_year,
  CAST(quarter(d) AS INTEGER) AS fiscal_quarter, CAST(month(d) AS INTEGER) AS fiscal_month
FROM c""")

sql("demand_forecast", """
SELECT DATE '2024-01-01' AS snapshot_date, 'WA-PHARMA-DIST' AS connection_id, 'ANTIVIR-WA-01' AS product_id, site_id,
  'USA-WA' AS region_id, 'SCN_RESERVED_NO_VALUE_PROVIDED' AS product_group_id,
  strftime(DATE '2024-01-01' + d, '%Y-%m-%d') || 'T00:00:00Z' AS forecast_start_dttm,
  strftime(DATE '2024-01-01' + d + 1, '%Y-%m-%d') || 'T00:00:00Z' AS forecast_end_dttm,
  CAST(CASE WHEN d < 7 THEN base WHEN d < 14 THEN trunc(base * (1.0 + (2 * (d - 7)) / 7.0)) ELSE base * 3 END AS BIGINT) AS mean
FROM (SELECT site_id, CASE site_type WHEN 'REGIONAL_HUB' THEN 100 WHEN 'DISTRIBUTION_CENTER' THEN 50 ELSE 20 END AS base,
        CAST(unnest(range(0, 30)) AS INTEGER) AS d FROM f_site) q""", "f_site")

sql("stock_allocation", """
SELECT DATE '2024-01-01' AS snapshot_date, site_id, 'ANTIVIR-WA-01' AS product_id, 'WA-PHARMA-DIST' AS connection_id,
  CAST(trunc(pop * CASE site_type WHEN 'REGIONAL_HUB' THEN 0.10 WHEN 'DISTRIBUTION_CENTER' THEN 0.05 ELSE 0.02 END) AS BIGINT)
    AS on_hand_inventory,
  'HEALTHY' AS inv_condition, 'LOT-2024-' || site_id AS lot_number, DATE '2024-12-31' AS expiry_date
FROM f_site""", "f_site")

sql("inventory_policy", "SELECT * FROM f_policy", "f_policy")
sql("site_dimension", "SELECT * FROM f_site_dim", "f_site_dim")

sql("assign_parent_dc", """
SELECT to_site_id AS site_id, from_site_id AS parent_dc_id, round(km, 6) AS parent_distance_km
FROM f_lane_edges WHERE kind = 'dc_local'""", "f_lane_edges")

sql("transport_lanes", "SELECT * FROM f_lanes", "f_lanes")

_ORDERS = """
WITH v AS (SELECT id, lead_time_days, row_number() OVER (ORDER BY seq) AS i FROM f_vendor),
dc AS (SELECT site_id, row_number() OVER (ORDER BY site_id) AS i FROM f_site WHERE site_type = 'DISTRIBUTION_CENTER'),
lo AS (SELECT site_id, row_number() OVER (ORDER BY site_id) AS i FROM f_site WHERE site_type = 'LOCAL_DISTRIBUTION'),
hub AS (SELECT min(site_id) AS hub_id FROM f_site WHERE site_type = 'REGIONAL_HUB')
"""
sql("inbound_orders", _ORDERS + """
SELECT printf('WA-VENDOR-PO-%03d', i) AS id, 'WA-PHARMA-DIST' AS connection_id, id AS tpartner_id,
  'PURCHASE_ORDER' AS order_type, CASE WHEN i = 1 THEN 'IN_TRANSIT' ELSE 'PENDING' END AS order_status FROM v
UNION ALL SELECT printf('WA-TRANSFER-TO-%03d', i), 'WA-PHARMA-DIST', 'INTERNAL-TRANSFER', 'STOCK_TRANSFER', 'APPROVED' FROM dc
UNION ALL SELECT printf('WA-LOCAL-TO-%03d', i), 'WA-PHARMA-DIST', 'INTERNAL-TRANSFER', 'STOCK_TRANSFER', 'PENDING' FROM lo""",
    "f_vendor", "f_site")

sql("inbound_order_lines", _ORDERS + """
SELECT order_id || '-LINE-001' AS id, order_id, 'WA-PHARMA-DIST' AS connection_id, tpartner_id,
  'ANTIVIR-WA-01' AS product_id, quantity_submitted, to_site_id, 'EA' AS quantity_uom, 'OPEN' AS status,
  expected_delivery_date
FROM (
  SELECT printf('WA-VENDOR-PO-%03d', i) AS order_id, id AS tpartner_id, CAST(5000 + 1000 * i AS BIGINT) AS quantity_submitted,
    (SELECT hub_id FROM hub) AS to_site_id, CAST(DATE '2024-01-01' + lead_time_days AS DATE) AS expected_delivery_date FROM v
  UNION ALL SELECT printf('WA-TRANSFER-TO-%03d', i), 'INTERNAL-TRANSFER', CAST(2000 AS BIGINT), site_id, DATE '2024-01-03' FROM dc
  UNION ALL SELECT printf('WA-LOCAL-TO-%03d', i), 'INTERNAL-TRANSFER', CAST(500 AS BIGINT), site_id, DATE '2024-01-02' FROM lo) q""",
    "f_vendor", "f_site")

_FULFIL = """
WITH per_city AS (
  SELECT city, arg_min(site_id, (CASE site_type WHEN 'REGIONAL_HUB' THEN 1 WHEN 'DISTRIBUTION_CENTER' THEN 2
                                  WHEN 'LOCAL_DISTRIBUTION' THEN 3 ELSE 9 END, site_id)) AS s
  FROM f_site WHERE city IS NOT NULL GROUP BY city),
hub AS (SELECT min(site_id) AS hub_id FROM f_site WHERE site_type = 'REGIONAL_HUB'),
ful AS (SELECT c.*, COALESCE(p.s, (SELECT hub_id FROM hub)) AS ship_from_site_id
        FROM f_customer c LEFT JOIN per_city p ON c.city = p.city)
"""
sql("fulfilment_site", _FULFIL + "SELECT * FROM ful", "f_customer", "f_site")

sql("outbound_demand", _FULFIL + """
SELECT 'OUT-' || id || '-' || k || '-' || printf('%03d', seq) AS id,
  'CUST-ORDER-' || printf('%03d', seq) || '-' || k AS cust_order_id,
  'WA-PHARMA-DIST' AS connection_id, 'ANTIVIR-WA-01' AS product_id, id AS customer_tpartner_id,
  CAST(CASE WHEN k = 'NORMAL' THEN (CASE WHEN customer_type = 'HOSPITAL' THEN 500 ELSE 200 END)
            ELSE (CASE WHEN customer_type = 'HOSPITAL' THEN 1500 ELSE 600 END) END AS BIGINT) AS init_quantity_requested,
  'EA' AS quantity_uom,
  CASE WHEN k = 'NORMAL' THEN DATE '2023-12-02' ELSE DATE '2024-01-01' END AS order_date,
  CASE WHEN k = 'NORMAL' THEN DATE '2023-12-04' ELSE DATE '2024-01-02' END AS requested_delivery_date,
  CASE WHEN k = 'NORMAL' THEN 'FULFILLED' ELSE 'PENDING' END AS status, ship_from_site_id
FROM ful CROSS JOIN (VALUES ('NORMAL'), ('SPIKE')) t(k)""", "f_customer", "f_site")

for _name, _view, _parent in (("geography_closure", "f_geography", "parent_geo_id"),
                              ("product_closure", "f_product_group", "parent_product_group_id")):
    sql(_name, f"""
WITH RECURSIVE closure(id, ancestor_id, distance) AS (
  SELECT id, id, 0 FROM {_view}
  UNION ALL
  SELECT c.id, h.{_parent}, c.distance + 1 FROM closure c JOIN {_view} h ON c.ancestor_id = h.id
  WHERE h.{_parent} IS NOT NULL)
SELECT id, ancestor_id, CAST(distance AS INTEGER) AS distance FROM closure""", _view)

sql("geography_dim", "SELECT * FROM f_geo_dim", "f_geo_dim")

sql("shipments", _FULFIL + """, lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-LINE-' || printf('%03d', l_linenumber) AS id,
    CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
    (lpad(CAST((l_suppkey * 6151) % 100000 AS VARCHAR), 5, '0') || CASE WHEN l_suppkey < 100000 THEN '' ELSE '-' || CAST(l_suppkey // 100000 AS VARCHAR) END) AS ship_from_site_id
  FROM lineitem)
SELECT 'SHIP-' || l.id AS id, o.tpartner_id AS supplier_tpartner_id, 'WA-PHARMA-DIST' AS connection_id, l.product_id,
  l.order_id, l.id AS order_line_id, 'PKG-' || l.id AS package_id, l.ship_from_site_id, ful.ship_from_site_id AS ship_to_site_id,
  CAST(o.order_date - CASE WHEN o.order_status = 'APPROVED' THEN 2 ELSE 1 END AS DATE) AS planned_ship_date,
  CAST(CASE WHEN o.order_status = 'APPROVED' THEN o.order_date - 1 ELSE o.order_date + 2 END AS DATE) AS planned_delivery_date,
  CAST(CASE WHEN o.order_status = 'APPROVED' THEN o.order_date - 1 END AS DATE) AS actual_delivery_date,
  CASE WHEN o.order_status = 'APPROVED' THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS shipment_status
FROM lines l JOIN f_inbound_order o ON l.order_id = o.id LEFT JOIN ful ON ful.id = o.tpartner_id
WHERE o.order_status IN ('IN_TRANSIT', 'APPROVED')""",
    "f_inbound_order", "f_customer", "f_site")

sql("trading_partners", """
SELECT id, name AS description, partner_type AS tpartner_type, city,
  CASE WHEN partner_type = 'CUSTOMER' THEN 'WA'
    ELSE (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = city) END AS state_prov, 'US' AS country,
  CASE WHEN partner_type = 'CUSTOMER' THEN 'GEO-US-WA' ELSE 'GEO-US' END AS geo_id,
  '1900-01-01T00:00:00Z' AS eff_start_date, '9999-12-31T23:59:59Z' AS eff_end_date
FROM f_partner
UNION ALL SELECT 'INTERNAL-TRANSFER', 'Internal Stock Transfer', 'INTERNAL', 'Seattle', 'WA', 'US', 'GEO-US-WA',
  '1900-01-01T00:00:00Z', '9999-12-31T23:59:59Z'
UNION ALL SELECT 'WH-' || site_id, city || ' Warehouse', 'WAREHOUSE', city, NULL, 'US', 'GEO-US',
  '1900-01-01T00:00:00Z', '9999-12-31T23:59:59Z' FROM f_site WHERE site_type = 'REGIONAL_HUB'""", "f_partner", "f_site")

sql("cdm_rename", "SELECT id, name AS description, partner_type AS tpartner_type, city FROM f_partner", "f_partner")

sql("conform_constants", """
SELECT id, name AS description, partner_type AS tpartner_type, city, 'US' AS country,
  'SCN_RESERVED_NO_VALUE_PROVIDED' AS geo_id, '1900-01-01T00:00:00Z' AS eff_start_date,
  '9999-12-31T23:59:59Z' AS eff_end_date FROM f_partner""", "f_partner")


# ---------------------------------------------------------------- event payloads

def _iso(e: str, tail: str = "T00:00:00Z") -> str:
    return f"strftime({e}, '%Y-%m-%d') || '{tail}'"


_PAYLOADS = {
    "geography": ("f_geo_dim", "id", [("id", "id"), ("description", "description"), ("parent_geo_id", "parent_geo_id"),
                                     ("country", "country"), ("state_prov", "state_prov"), ("city", "city")]),
    "product_hierarchy": ("f_product_group", "id", [("id", "id"), ("description", "id"),
                                                    ("parent_product_group_id", "parent_product_group_id")]),
    "trading_partner": ("f_partner", "id", [("id", "id"), ("description", "name"), ("city", "city"),
                                            ("tpartner_type", "partner_type"),
                                            ("geo_id", "'SCN_RESERVED_NO_VALUE_PROVIDED'"),
                                            ("eff_start_date", "'1900-01-01T00:00:00Z'"),
                                            ("eff_end_date", "'9999-12-31T23:59:59Z'")]),
    "site": ("f_site_dim", "id", [(c, c) for c in ("id", "description", "site_type", "geo_id", "latitude", "longitude",
                                                   "city", "state_prov", "postal_code", "country")]),
    "inv_policy": ("f_policy", "id", [(c, c) for c in (
        "id", "site_id", "product_id", "product_group_id", "dest_geo_id", "vendor_tpartner_id", "ss_policy",
        "min_safety_stock", "max_safety_stock", "target_inventory_qty", "min_order_qty", "max_order_qty")]
        + [("eff_start_date", _iso("eff_start_date")), ("eff_end_date", _iso("eff_end_date", "T23:59:59Z"))]),
    "inv_level": ("f_inv_event", "lot_number", [
        ("snapshot_date", _iso("snapshot_date")), ("site_id", "site_id"), ("product_id", "product_id"),
        ("on_hand_inventory", "CAST(on_hand_inventory AS VARCHAR)"), ("inv_condition", "inv_condition"),
        ("lot_number", "lot_number"), ("expiry_date", _iso("expiry_date"))]),
    "inbound_order": ("f_inbound_order", "id", [("id", "id"), ("tpartner_id", "tpartner_id"),
                                                ("order_status", "order_status")]),
}
_PRODUCT = """(SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS description, 'EA' AS base_uom, p_type AS product_type
   FROM part) x"""
_LINES = """(SELECT CAST(l_orderkey AS VARCHAR) || '-LINE-' || printf('%03d', l_linenumber) AS id,
   CAST(l_orderkey AS VARCHAR) AS order_id, 'INTERNAL-TRANSFER' AS tpartner_id, CAST(l_partkey AS VARCHAR) AS product_id,
   CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity_submitted,
   CASE WHEN l_linestatus = 'O' THEN 'OPEN' END AS status, CAST(l_shipdate AS DATE) AS expected_delivery_date
   FROM lineitem) x"""


def _payload_sql(ds: str) -> tuple[str, tuple[str, ...]]:
    if ds == "product":
        body = (f"SELECT 'product' AS dataset, id AS record_key, "
                f"{jobj(('id', 'id'), ('description', 'description'), ('base_uom', 'base_uom'), ('product_type', 'product_type'))}"
                f" AS payload FROM {_PRODUCT}")
        return body, ()
    if ds == "inbound_order_line":
        cols = [(c, c) for c in ("id", "order_id", "tpartner_id", "product_id", "quantity_submitted", "status")]
        cols.append(("expected_delivery_date", _iso("expected_delivery_date")))
        return f"SELECT 'inbound_order_line' AS dataset, id AS record_key, {jobj(*cols)} AS payload FROM {_LINES}", ()
    view, key, cols = _PAYLOADS[ds]
    return f"SELECT '{ds}' AS dataset, CAST({key} AS VARCHAR) AS record_key, {jobj(*cols)} AS payload FROM {view}", (view,)


for _ds in ("geography", "product_hierarchy", "product", "trading_partner", "site", "inv_policy", "inv_level",
            "inbound_order", "inbound_order_line"):
    _b, _v = _payload_sql(_ds)
    sql(f"event_payload_{_ds}", _b, *_v)

sql("event_routing", """
WITH counted AS (
  SELECT 'site' AS dataset, count(*) AS records FROM f_site
  UNION ALL SELECT 'forecast', count(*) * 30 FROM f_site
  UNION ALL SELECT 'inv_level', count(*) FROM f_inv_level
  UNION ALL SELECT 'transportation_lane', count(*) FROM f_lanes
  UNION ALL SELECT 'inbound_order', count(*) FROM f_inbound_order)
SELECT dataset, records,
  CASE dataset WHEN 'inv_level' THEN 'scn.data.inventorylevel' WHEN 'inbound_order' THEN 'scn.data.inboundorder'
    WHEN 'site' THEN 'scn.data.dataset' END AS event_type,
  CASE WHEN dataset = 'site' THEN 'UPSERT' END AS operation,
  dataset IN ('site', 'inv_level', 'inbound_order') AS eligible
FROM counted""", "f_site", "f_inv_level", "f_lanes", "f_inbound_order")

_p_inv, _ = _payload_sql("inv_level")
_p_site, _ = _payload_sql("site")
_p_ord, _ = _payload_sql("inbound_order")
sql("event_batches", f"""
WITH p AS ({_p_inv} UNION ALL {_p_site} UNION ALL {_p_ord}),
n AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY record_key, payload) AS rn FROM p),
b AS (SELECT dataset, CAST(floor((rn - 1) / 100) + 1 AS INTEGER) AS batch_no, count(*) AS records,
        '[' || string_agg(payload, ',' ORDER BY rn) || ']' AS data
      FROM n GROUP BY dataset, floor((rn - 1) / 100))
SELECT dataset, batch_no, dataset || '-20240101000000' AS event_group_id,
  CASE dataset WHEN 'inv_level' THEN 'scn.data.inventorylevel' WHEN 'inbound_order' THEN 'scn.data.inboundorder'
    ELSE 'scn.data.dataset' END AS event_type,
  CASE WHEN dataset = 'site' THEN 'UPSERT' END AS operation, records, data
FROM b""", "f_inv_event", "f_site_dim", "f_inbound_order")

sql("event_batches_arriving", f"""
WITH p AS ({_p_inv} UNION ALL {_p_site} UNION ALL {_p_ord}),
n AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY ascii(right(record_key, 1)) % 3, record_key, payload) AS rn FROM p),
b AS (SELECT dataset, CAST(floor((rn - 1) / 100) + 1 AS INTEGER) AS batch_no, count(*) AS records,
        '[' || string_agg(payload, ',' ORDER BY rn) || ']' AS data
      FROM n GROUP BY dataset, floor((rn - 1) / 100))
SELECT dataset, batch_no, dataset || '-20240101000000' AS event_group_id,
  CASE dataset WHEN 'inv_level' THEN 'scn.data.inventorylevel' WHEN 'inbound_order' THEN 'scn.data.inboundorder'
    ELSE 'scn.data.dataset' END AS event_type,
  CASE WHEN dataset = 'site' THEN 'UPSERT' END AS operation, records, data, records = 100 AS closed
FROM b""", "f_inv_event", "f_site_dim", "f_inbound_order")


# ---------------------------------------------------------------- remaining coverage

sql("candidate_sites", """
WITH cand AS (SELECT latitude AS c_lat, longitude AS c_lon, min(zip_code) AS candidate_id FROM f_zone
              WHERE latitude IS NOT NULL GROUP BY latitude, longitude),
z AS (SELECT latitude AS z_lat, longitude AS z_lon, population AS pop, distance_km AS d_now FROM f_access
      WHERE latitude IS NOT NULL AND distance_km IS NOT NULL AND population > 0),
p AS (SELECT candidate_id, c_lat, c_lon, pop, d_now, 6371 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS d
      FROM (SELECT c.*, z.*, power(sin(radians(c.c_lat - z.z_lat) / 2), 2) + cos(radians(z.z_lat)) * cos(radians(c.c_lat))
              * power(sin(radians(c.c_lon - z.z_lon) / 2), 2) AS a FROM z CROSS JOIN cand c) q),
g AS (SELECT candidate_id, c_lat, c_lon, count(*) AS zones_helped, CAST(sum(pop) AS BIGINT) AS population_helped,
        sum(pop * (d_now - d)) AS gain FROM p WHERE d < d_now GROUP BY candidate_id, c_lat, c_lon),
base AS (SELECT sum(population * distance_km) AS wd, CAST(sum(population) AS DOUBLE) AS w FROM f_access
         WHERE distance_km IS NOT NULL AND population > 0)
SELECT CAST(row_number() OVER (ORDER BY gain DESC, candidate_id) AS INTEGER) AS rank, candidate_id, c_lat AS latitude,
  c_lon AS longitude, zones_helped, population_helped, round(gain, 1) AS gain,
  round((base.wd - gain) / base.w, 6) AS new_pop_weighted_distance_km
FROM g CROSS JOIN base ORDER BY gain DESC, candidate_id LIMIT 5""", "f_zone", "f_access")

_KM = "6371 * 2 * atan2(sqrt(a), sqrt(1 - a))"


def _joint_sites(k: int) -> str:
    """Plain greedy, one block of CTEs for each site: all zones by all candidates every time."""
    half = lambda c, z: (f"power(sin(radians({c}.c_lat - {z}.z_lat) / 2), 2) + cos(radians({z}.z_lat)) * cos(radians({c}.c_lat)) "  # noqa: E731
                         f"* power(sin(radians({c}.c_lon - {z}.z_lon) / 2), 2) AS a")
    parts = ["""cand AS (SELECT latitude AS c_lat, longitude AS c_lon, min(zip_code) AS candidate_id FROM f_zone
  WHERE latitude IS NOT NULL GROUP BY latitude, longitude)""",
             """z1 AS (SELECT row_number() OVER () AS zid, latitude AS z_lat, longitude AS z_lon, population AS pop, distance_km AS d_now FROM f_access
  WHERE latitude IS NOT NULL AND distance_km IS NOT NULL AND population > 0)""",
             "base AS (SELECT sum(pop * d_now) AS wd, CAST(sum(pop) AS DOUBLE) AS w FROM z1)"]
    for n in range(1, k + 1):
        parts.append(f"""p{n} AS (SELECT *, {_KM} AS d FROM (SELECT c.*, z.zid, z.pop, z.d_now, {half('c', 'z')} FROM z{n} z CROSS JOIN cand c))""")
        parts.append(f"""b{n} AS MATERIALIZED (SELECT candidate_id, c_lat, c_lon, count(*) AS zones_helped, CAST(sum(pop) AS BIGINT) AS population_helped,
  sum(pop * (d_now - d)) AS gain FROM p{n} WHERE d < d_now GROUP BY ALL ORDER BY gain DESC, candidate_id LIMIT 1)""")
        parts.append(f"""z{n + 1} AS MATERIALIZED (SELECT zid, z_lat, z_lon, pop, least(d_now, {_KM}) AS d_now
  FROM (SELECT z.*, {half('c', 'z')} FROM z{n} z CROSS JOIN b{n} c))""")
    picks = " UNION ALL ".join(f"SELECT {n} AS rank, * FROM b{n}" for n in range(1, k + 1))
    return f"""WITH {", ".join(parts)}, picks AS ({picks})
SELECT CAST(rank AS INTEGER) AS rank, candidate_id, c_lat AS latitude, c_lon AS longitude, zones_helped, population_helped, round(gain, 1) AS gain,
  round((base.wd - sum(gain) OVER (ORDER BY rank)) / base.w, 6) AS new_pop_weighted_distance_km FROM picks CROSS JOIN base"""


sql("candidate_sites_joint", _joint_sites(3), "f_zone", "f_access")

sql("haversine_pairs", """
SELECT l_orderkey AS order_key, count(*) AS lines, round(sum(d), 6) AS total_km, round(max(d), 6) AS max_km
FROM (SELECT l.l_orderkey, 6371 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS d FROM (
  SELECT l.l_orderkey, power(sin(radians(s_lat - z_lat) / 2), 2) + cos(radians(z_lat)) * cos(radians(s_lat))
           * power(sin(radians(s_lon - z_lon) / 2), 2) AS a
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN (SELECT c_custkey,
          CASE WHEN c_custkey % 101 <> 0 THEN 45.5 + CAST((c_custkey * 37) % 350 AS DOUBLE) / 100 END AS z_lat,
          CASE WHEN c_custkey % 101 <> 0 THEN -124.5 + CAST((c_custkey * 91) % 760 AS DOUBLE) / 100 END AS z_lon
        FROM customer) c ON o.o_custkey = c.c_custkey
  JOIN (SELECT s_suppkey, 45.5 + CAST((s_suppkey * 53) % 350 AS DOUBLE) / 100 AS s_lat,
          -124.5 + CAST((s_suppkey * 113) % 760 AS DOUBLE) / 100 AS s_lon FROM supplier) s ON l.l_suppkey = s.s_suppkey) l) q
GROUP BY l_orderkey""")


# ---------------------------------------------------------------- validation

_FAILURES = """
SELECT 'company' AS dataset, 'unreadable' AS "check", CAST(NULL AS VARCHAR) AS field, 'File not found' AS message
UNION ALL SELECT 'inv_policy', 'empty', NULL, 'Dataset is empty'
UNION ALL SELECT 'trading_partner', 'missing_required', 'description', 'Missing required field: description'
UNION ALL SELECT 'trading_partner', 'missing_required', 'tpartner_type', 'Missing required field: tpartner_type'
UNION ALL SELECT 'trading_partner', 'forbidden_present', 'name', 'Forbidden field present: name'
UNION ALL SELECT 'trading_partner', 'forbidden_present', 'partner_type', 'Forbidden field present: partner_type'
UNION ALL SELECT 'product', 'forbidden_present', 'category', 'Forbidden field present: category'
UNION ALL SELECT 'product', 'forbidden_present', 'unit_of_measure', 'Forbidden field present: unit_of_measure'
UNION ALL SELECT 'inv_level', 'nulls', 'site_id', 'Field ''site_id'' has ' || CAST(count(*) AS VARCHAR) || ' null values'
  FROM f_inv_level WHERE site_id = 'UNKNOWN' HAVING count(*) > 0"""
sql("validate_datasets", _FAILURES, "f_inv_level")

sql("validate_nulls", """
WITH inv AS (SELECT NULLIF(site_id, 'UNKNOWN') AS site_id, product_id, on_hand_inventory, snapshot_date FROM f_inv_level)
SELECT 'geography' AS dataset, 'id' AS field, count(*) FILTER (WHERE id IS NULL) AS null_count FROM f_geography
UNION ALL SELECT 'geography', 'description', count(*) FILTER (WHERE id IS NULL) FROM f_geography
UNION ALL SELECT 'calendar', 'calendar_id', CAST(0 AS BIGINT) UNION ALL SELECT 'calendar', 'date', 0
UNION ALL SELECT 'product_hierarchy', 'id', count(*) FILTER (WHERE id IS NULL) FROM f_product_group
UNION ALL SELECT 'product_hierarchy', 'description', count(*) FILTER (WHERE id IS NULL) FROM f_product_group
UNION ALL SELECT 'product', 'id', count(*) FILTER (WHERE p_partkey IS NULL) FROM part
UNION ALL SELECT 'product', 'description', count(*) FILTER (WHERE p_name IS NULL) FROM part
UNION ALL SELECT 'site', 'id', count(*) FILTER (WHERE site_id IS NULL) FROM f_site
UNION ALL SELECT 'site', 'description', count(*) FILTER (WHERE city IS NULL) FROM f_site
UNION ALL SELECT 'trading_partner', 'id', count(*) FILTER (WHERE id IS NULL) FROM f_partner
UNION ALL SELECT 'inv_policy', 'id', 0 UNION ALL SELECT 'inv_policy', 'site_id', 0
UNION ALL SELECT 'transportation_lane', c, 0 FROM (VALUES ('id'), ('from_site_id'), ('to_site_id')) t(c)
UNION ALL SELECT 'inv_policy', 'product_id', 0
UNION ALL SELECT 'forecast', 'snapshot_date', 0 UNION ALL SELECT 'forecast', 'site_id', count(*) FILTER (WHERE site_id IS NULL) FROM f_site
UNION ALL SELECT 'forecast', 'product_id', 0
UNION ALL SELECT 'inv_level', 'product_id', count(*) FILTER (WHERE product_id IS NULL) FROM inv
UNION ALL SELECT 'inv_level', 'site_id', count(*) FILTER (WHERE site_id IS NULL) FROM inv
UNION ALL SELECT 'inv_level', 'on_hand_inventory', count(*) FILTER (WHERE on_hand_inventory IS NULL) FROM inv
UNION ALL SELECT 'inv_level', 'snapshot_date', count(*) FILTER (WHERE snapshot_date IS NULL) FROM inv
UNION ALL SELECT 'inbound_order', 'id', count(*) FILTER (WHERE id IS NULL) FROM f_inbound_order
UNION ALL SELECT 'inbound_order', 'tpartner_id', count(*) FILTER (WHERE tpartner_id IS NULL) FROM f_inbound_order
UNION ALL SELECT 'inbound_order_line', 'id', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'inbound_order_line', 'order_id', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'inbound_order_line', 'product_id', count(*) FILTER (WHERE l_partkey IS NULL) FROM lineitem
UNION ALL SELECT 'shipment', 'id', 0 UNION ALL SELECT 'shipment', 'product_id', 0
UNION ALL SELECT 'outbound_order_line', 'id', 0 UNION ALL SELECT 'outbound_order_line', 'product_id', 0""",
    "f_geography", "f_product_group", "f_site", "f_partner", "f_inv_level", "f_inbound_order")

sql("validate_summary", f"""
WITH f AS ({_FAILURES}),
names AS (SELECT unnest(['company', 'geography', 'calendar', 'product_hierarchy', 'product', 'site',
  'transportation_lane', 'trading_partner', 'inv_policy', 'forecast', 'inv_level', 'inbound_order',
  'inbound_order_line', 'shipment', 'outbound_order_line']) AS dataset),
per AS (SELECT n.dataset, CAST(count(f.dataset) AS BIGINT) AS errors FROM names n LEFT JOIN f ON n.dataset = f.dataset
        GROUP BY n.dataset)
SELECT dataset, errors, errors = 0 AS valid, CAST(NULL AS BIGINT) AS valid_datasets, CAST(NULL AS BIGINT) AS total_datasets
FROM per
UNION ALL SELECT 'ALL', CAST(sum(errors) AS BIGINT), bool_and(errors = 0), CAST(count(*) FILTER (WHERE errors = 0) AS BIGINT),
  CAST(count(*) AS BIGINT) FROM per""", "f_inv_level")

_KEYS = """
SELECT 'geography' AS dataset, 7 AS field_count, 'id' AS key_fields, id AS k FROM f_geography
UNION ALL SELECT 'calendar', 11, 'calendar_id', CAST(i AS VARCHAR)
  FROM range(0, (SELECT CAST(max(CAST(o_orderdate AS DATE)) - min(CAST(o_orderdate AS DATE)) + 1 AS BIGINT) FROM orders)) t(i)
UNION ALL SELECT 'product_hierarchy', 4, 'id', id FROM f_product_group
UNION ALL SELECT 'product', 6, 'id', CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT 'site', 11, 'id', site_id FROM f_site
UNION ALL SELECT 'transportation_lane', 17, 'id', id FROM f_lanes
UNION ALL SELECT 'trading_partner', 4, 'id', id FROM f_partner
UNION ALL SELECT 'forecast', 9, 'snapshot_date,site_id,product_id,forecast_start_dttm', site_id || '/' || CAST(i AS VARCHAR) FROM f_site CROSS JOIN range(30) t(i)
UNION ALL SELECT 'inv_level', 8, 'snapshot_date,site_id,product_id,lot_number', concat_ws('/', CAST(snapshot_date AS VARCHAR), site_id, product_id) FROM f_inv_level
UNION ALL SELECT 'inbound_order', 4, 'id', id FROM f_inbound_order
UNION ALL SELECT 'inbound_order_line', 8, 'id', printf('%d-%d', l_orderkey, l_linenumber) FROM lineitem
UNION ALL SELECT 'shipment', 13, 'id', printf('%d-%d', l_orderkey, l_linenumber) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O')
UNION ALL SELECT 'outbound_order_line', 11, 'id', concat(id, k) FROM f_customer CROSS JOIN (VALUES ('N'), ('S')) t(k)"""
sql("dataset_profile", f"""
WITH k AS (SELECT dataset, field_count, key_fields, k, count(*) AS n FROM ({_KEYS}) GROUP BY ALL)
SELECT dataset, CAST(sum(n) AS BIGINT) AS rows, field_count, key_fields, count(*) FILTER (WHERE n > 1) AS duplicate_keys
FROM k GROUP BY dataset, field_count, key_fields
UNION ALL SELECT 'inv_policy', CAST(0 AS BIGINT), 15, 'id', CAST(0 AS BIGINT)""",
    "f_geography", "f_product_group", "f_site", "f_lanes", "f_partner", "f_inv_level", "f_inbound_order", "f_customer")

sql("key_duplicates", """
SELECT 'inv_level' AS dataset, snapshot_date, site_id, product_id, 'LOT-' || product_id AS lot_number,
  count(*) AS occurrences
FROM f_inv_level GROUP BY snapshot_date, site_id, product_id HAVING count(*) > 1""", "f_inv_level")


# ---------------------------------------------------------------- files

sql("csv_roundtrip", "SELECT * FROM f_site_dim", "f_site_dim")

sql("publish_append", """
SELECT '20240101_000000' AS load_ts, count(*) AS rows, CAST(sum(on_hand_inventory) AS BIGINT) AS on_hand FROM f_inv_level
UNION ALL
SELECT '20240102_000000', count(*), CAST(sum(on_hand_inventory + 1) AS BIGINT) FROM f_inv_level""", "f_inv_level")

sql("publish_replace", """
SELECT '20240102_000000' AS load_ts, count(*) AS rows, CAST(sum(on_hand_inventory + 1) AS BIGINT) AS on_hand
FROM f_inv_level""", "f_inv_level")

sql("lake_latest", """
SELECT snapshot_date, site_id, product_id, on_hand_inventory + 1 AS on_hand_inventory, inv_condition, lot_number,
  expiry_date, '20240102_000000' AS load_ts FROM f_inv_event""", "f_inv_event")

sql("publish_manifest", """
SELECT 'inv_level' AS dataset, '20240101_000000' AS load_ts, count(*) AS rows, true AS nonempty, true AS csv
FROM f_inv_level
UNION ALL SELECT 'inv_level', '20240102_000000', count(*), true, true FROM f_inv_level
UNION ALL SELECT 'site', '20240101_000000', count(*), true, true FROM f_site
UNION ALL SELECT 'product', '20240101_000000', count(*), true, true FROM part""", "f_inv_level", "f_site")

sql("file_inventory", """
WITH names AS (SELECT unnest(['company', 'geography', 'calendar', 'product_hierarchy', 'product', 'site',
  'transportation_lane', 'trading_partner', 'inv_policy', 'forecast', 'inv_level', 'inbound_order',
  'inbound_order_line', 'shipment', 'outbound_order_line']) AS dataset,
  unnest(range(0, 15)) AS ord),
per AS (SELECT dataset, CAST(ord AS INTEGER) AS ord, CAST(CASE dataset WHEN 'site' THEN (SELECT count(*) FROM f_site)
    WHEN 'product' THEN (SELECT count(*) FROM part) WHEN 'inv_level' THEN 2 * (SELECT count(*) FROM f_inv_level) ELSE 0 END AS BIGINT) AS rows
  FROM names)
SELECT dataset, ord, rows, true AS files_agree, true AS bytes_agree, dataset IN ('site', 'product', 'inv_level') AS has_latest_file FROM per
UNION ALL SELECT 'TOTAL', 15, CAST(sum(rows) AS BIGINT), true, true, false FROM per""", "f_site", "f_inv_level")


# ---------------------------------------------------------------- streaming

sql("flow_incremental", """
SELECT site_id, product_id, on_hand_inventory, snapshot_date, lot_number FROM f_inv_event""", "f_inv_event")

sql("flow_log", """
SELECT 'wa-inv-level' AS flow_name,
  'wa-inv-level-' || CASE WHEN snapshot_date < DATE '1996-01-01' THEN '0' ELSE '1' END AS execution_id,
  'SUCCEEDED' AS status, count(*) AS records_processed, CAST(0 AS BIGINT) AS records_failed, true AS has_bytes,
  true AS ordered_times
FROM f_inv_level GROUP BY 2""", "f_inv_level")

sql("flow_rejects", """
WITH b AS (SELECT CASE WHEN CAST(product_id AS BIGINT) % 21 = 0 THEN 'value does not fit: on_hand_inventory, expiry_date'
                       ELSE 'value does not fit: on_hand_inventory' END AS reason FROM f_inv_level WHERE CAST(product_id AS BIGINT) % 7 = 0)
SELECT reason, count(*) AS records, (SELECT count(*) FROM b) AS logged_failed FROM b GROUP BY reason""", "f_inv_level")

sql("event_upsert", """
SELECT id, event_ts, seq, status, value FROM f_upsert
QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_ts DESC, seq DESC) = 1""", "f_upsert")

sql("events_daily", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS events FROM events GROUP BY 1, 2""")


# A window is written once the greatest time seen is a day past its end. Late rows count only in windows that were
# still open by the rows on time.
sql("events_daily_append", """
WITH e AS (SELECT *, CAST(date_trunc('day', ts) AS DATE) AS day, event_id % 20 = 3 AS late FROM events),
m AS (SELECT max(ts) - INTERVAL 1 DAY AS final, max(ts) FILTER (WHERE NOT late) - INTERVAL 1 DAY AS on_time FROM e)
SELECT day, event_type, count(*) AS events FROM e, m
WHERE day + INTERVAL 1 DAY <= final AND NOT (late AND day + INTERVAL 1 DAY <= on_time) GROUP BY ALL""")


# ---------------------------------------------------------------- monitoring

sql("execution_stats", """
WITH flows AS (SELECT printf('s3-%d-flow', i) AS flow_name FROM range(0, 20) t(i)),
per AS (SELECT f.flow_name, count(e.execution_id) AS n, count(*) FILTER (WHERE e.status = 'SUCCEEDED') AS ok,
          count(*) FILTER (WHERE e.status = 'FAILED') AS failed,
          count(*) FILTER (WHERE e.status IN ('RUNNING', 'IN_PROGRESS')) AS running
        FROM flows f LEFT JOIN f_execution e ON f.flow_name = e.flow_name GROUP BY f.flow_name)
SELECT count(*) AS total_flows, count(*) FILTER (WHERE n > 0) AS flows_with_executions,
  count(*) FILTER (WHERE n = 0) AS flows_without_executions, CAST(sum(n) AS BIGINT) AS total_executions,
  CAST(sum(ok) AS BIGINT) AS succeeded, CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(running) AS BIGINT) AS running,
  CAST(sum(n) - sum(ok) - sum(failed) - sum(running) AS BIGINT) AS other,
  round(CAST(sum(ok) AS DOUBLE) / NULLIF(sum(n), 0) * 100, 6) AS success_rate_pct
FROM per""", "f_execution")

sql("recent_executions", """
SELECT *, CAST(row_number() OVER (PARTITION BY flow_name ORDER BY start_time DESC, execution_id) AS INTEGER) AS recent_rank
FROM f_execution QUALIFY recent_rank <= 3""", "f_execution")

sql("recent_events", """
SELECT event_id, event_type, ts AS event_timestamp,
  CAST(row_number() OVER (ORDER BY ts DESC, event_id) AS INTEGER) AS rank
FROM events ORDER BY ts DESC, event_id LIMIT 20""")

sql("failed_executions", """
SELECT flow_name, execution_id, start_time, end_time, records_processed, records_failed, bytes_processed, CAST(i AS INTEGER) AS message_no,
  CASE WHEN i = 1 THEN 'ERROR' ELSE 'INFO' END AS message_type,
  'execution ' || CAST(execution_id AS VARCHAR) || ' message ' || CAST(i AS VARCHAR) AS message
FROM f_execution CROSS JOIN range(1, 5) t(i) WHERE status = 'FAILED'""", "f_execution")

sql("failed_executions_top3", f"SELECT * FROM ({ORACLE['failed_executions']}) WHERE message_no <= 3")

sql("event_rejects", """
SELECT 'forecast' AS dataset, site_id || '/2024-01-01' AS record_key FROM f_site CROSS JOIN range(30)
UNION ALL
SELECT 'shipment', 'SHIP-' || CAST(l_orderkey AS VARCHAR) || '-LINE-' || printf('%03d', l_linenumber)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O')""", "f_site")

sql("flow_throughput", """
SELECT flow_name, count(*) AS executions, CAST(sum(records_processed) AS BIGINT) AS records_processed,
  CAST(sum(records_failed) AS BIGINT) AS records_failed, CAST(sum(bytes_processed) AS BIGINT) AS bytes_processed
FROM f_execution GROUP BY flow_name""", "f_execution")
