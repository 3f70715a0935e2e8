"""SQL oracle: the same panels rebuilt from the driver tables in plain SQL.

Every oracle query is ``WITH <panel CTEs> <query over prices>``; the CTEs
are written independently of the DataFrame code (FIXTURES.md F1/F2) so the
two sides only share the specification.
"""

from __future__ import annotations

F1_CTES = """
raw AS (
  SELECT CAST(date_trunc('month', l.l_shipdate) AS TIMESTAMP) AS timestamp,
    CASE CAST(l.l_suppkey AS INT) % 8 WHEN 0 THEN 'aws' WHEN 1 THEN 'gcp' WHEN 2 THEN 'azure' WHEN 3 THEN 'oci'
      WHEN 4 THEN 'lambdalabs' WHEN 5 THEN 'runpod' WHEN 6 THEN 'vastai' ELSE 'nebius' END AS provider,
    lower(concat(p.p_type, '-', CAST(l.l_partkey // 500 AS VARCHAR))) AS instance_type,
    CASE WHEN p.p_size = 50 THEN 'Unknown' ELSE p.p_name END AS gpu_type,
    CAST(l.l_linenumber AS INT) - 1 AS gpu_count,
    CASE WHEN p.p_size % 12 = 0 THEN NULL ELSE (p.p_size % 12) * 8 END AS gpu_memory_gb,
    p.p_size * 2 AS vcpus, p.p_retailprice AS ram_gb, n.n_name AS region,
    l.l_extendedprice / 997e0 AS price_per_hour,
    l.l_returnflag = 'R' AS is_spot,
    CASE WHEN l.l_discount = 0 THEN NULL ELSE l.l_tax < 0.06 END AS available,
    CAST(NULL AS VARCHAR) AS availability_zone,
    l.l_orderkey AS seq_a, l.l_partkey AS seq_b, l.l_suppkey AS seq_c
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
),
listings AS (
  SELECT timestamp, provider, instance_type, gpu_type, gpu_count, gpu_memory_gb, vcpus, ram_gb, region,
         price_per_hour, is_spot, available, availability_zone
  FROM (SELECT *, row_number() OVER (PARTITION BY timestamp, provider, instance_type, region, is_spot
        ORDER BY seq_a DESC, seq_b DESC, seq_c DESC, price_per_hour DESC, gpu_count DESC,
                 gpu_memory_gb DESC NULLS LAST) AS rn FROM raw) t
  WHERE rn = 1
),
regions AS (
  SELECT pv.provider, n.n_name AS raw_region,
    lower(concat(r.r_name, '-', n.n_name, CASE WHEN n.n_nationkey % 5 = 1 THEN '-zone' ELSE '' END)) AS region_canonical,
    n.n_name AS country,
    CAST(n.n_nationkey - n.n_nationkey % 2 AS DOUBLE) * 1.5e0 + 20 + (n.n_nationkey % 2 * 0.001e0 + pv.idx * 0.0004e0) AS lat,
    CAST(n.n_nationkey - n.n_nationkey % 2 AS DOUBLE) * -2.5e0 - 70 + (n.n_nationkey % 2 * 0.001e0 + pv.idx * 0.0004e0) AS lon,
    r.r_name AS region_group
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  CROSS JOIN (VALUES (0,'aws'),(1,'gcp'),(2,'azure'),(3,'oci'),(4,'lambdalabs'),(5,'runpod'),(6,'vastai'),(7,'nebius')) pv(idx, provider)
  WHERE n.n_nationkey % 7 <> 3
),
prices AS (
  SELECT l.*,
    CASE WHEN l.gpu_count <= 0 THEN 'cpu_only' WHEN l.gpu_type = 'Unknown' THEN 'unknown_gpu'
         WHEN l.gpu_memory_gb IS NULL THEN 'missing_memory' ELSE 'ok' END AS quality,
    r.region_canonical, r.country, r.lat AS region_lat, r.lon AS region_lon, r.region_group,
    CAST(l.timestamp AS DATE) AS dt
  FROM listings l LEFT JOIN regions r ON l.provider = r.provider AND l.region = r.raw_region
)"""

_F2 = """
raw AS (
  SELECT {stamp} AS timestamp,
    CASE event_type WHEN 'view' THEN 'aws' WHEN 'click' THEN 'gcp' WHEN 'purchase' THEN 'vastai' WHEN 'signup' THEN 'runpod' ELSE 'azure' END AS provider,
    concat('sku-', CAST(user_id // 15 AS VARCHAR)) AS instance_type,
    CASE user_id % 5 WHEN 0 THEN 'H100' WHEN 1 THEN 'A100' WHEN 2 THEN 'L40S' WHEN 3 THEN 'T4' ELSE 'A10' END AS gpu_type,
    CAST(1 + event_id % 4 AS INT) AS gpu_count,
    24 AS gpu_memory_gb,
    CAST((1 + event_id % 4) * 8 AS INT) AS vcpus,
    (1 + event_id % 4) * 32e0 AS ram_gb,
    concat('r', CAST(user_id % 3 AS VARCHAR)) AS region,
    value / 97e0 AS price_per_hour, event_id % 3 = 0 AS is_spot,
    CAST(NULL AS BOOLEAN) AS available, CAST(NULL AS VARCHAR) AS availability_zone,
    ts AS seq_a, event_id AS seq_b
  FROM events{only}
),
prices AS (
  SELECT timestamp, provider, instance_type, gpu_type, gpu_count, gpu_memory_gb, vcpus, ram_gb, region,
         price_per_hour, is_spot, available, availability_zone,
         CASE WHEN gpu_count <= 0 THEN 'cpu_only' WHEN gpu_type = 'Unknown' THEN 'unknown_gpu'
              WHEN gpu_memory_gb IS NULL THEN 'missing_memory' ELSE 'ok' END AS quality,
         CAST(NULL AS VARCHAR) AS region_canonical, CAST(NULL AS VARCHAR) AS country,
         CAST(NULL AS DOUBLE) AS region_lat, CAST(NULL AS DOUBLE) AS region_lon,
         CAST(NULL AS VARCHAR) AS region_group, CAST(timestamp AS DATE) AS dt
  FROM (SELECT *, row_number() OVER (PARTITION BY timestamp, provider, instance_type, region, is_spot
        ORDER BY seq_a DESC, seq_b DESC) AS rn FROM raw) t
  WHERE rn = 1
)"""


_SLOT = ("date_trunc('day', ts) + CASE WHEN extract(hour FROM ts) >= 12 THEN INTERVAL '12 hours' "
         "ELSE INTERVAL '0 hours' END")
F2_CTES = _F2.format(stamp=_SLOT, only="")
# With gaps: no snapshot on days 12 to 20, providers that come late or vanish, stamps minutes into the slot.
F2_GAP_CTES = _F2.format(
    stamp=f"{_SLOT} + to_minutes((extract(day FROM ts) * 7 + CASE WHEN extract(hour FROM ts) >= 12 THEN 12 ELSE 0 END) % 23)"
          " + INTERVAL 17 SECOND",
    only="""
  WHERE extract(day FROM ts) NOT BETWEEN 12 AND 20
    AND NOT (event_type = 'purchase' AND ts < TIMESTAMP '2024-01-04 00:00:00')
    AND NOT (event_type = 'error'    AND ts >= TIMESTAMP '2024-01-21 00:00:00')
    AND NOT (event_type = 'signup'   AND ts >= TIMESTAMP '2024-01-29 12:00:00')""")


def f1(query: str) -> str:
    """Oracle over the monthly listing panel (tables: raw, listings, regions, prices)."""
    return "WITH " + F1_CTES.strip() + "\n" + query.strip()


def f2(query: str) -> str:
    """Oracle over the half-day events panel (tables: raw, prices)."""
    return "WITH " + F2_CTES.strip() + "\n" + query.strip()


def f2_gaps(query: str) -> str:
    """Oracle over the events panel with gaps (tables: raw, prices)."""
    return "WITH " + F2_GAP_CTES.strip() + "\n" + query.strip()
