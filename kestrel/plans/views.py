"""Oracle SQL for the proxy views (DuckDB dialect), used as CTEs.

Each text mirrors the Spark definition in ``kestrel.sources.proxies`` and
``kestrel.plans.score_views``: money in integer cents, half-up rounding by
integer division, md5-based pseudo-randomness.
"""

from __future__ import annotations

AUCTION = """auction AS (
  SELECT o.o_orderkey AS row_id,
         CAST(o.o_orderpriority = '1-URGENT' AS INTEGER) AS IsBadBuy,
         o.o_orderdate AS PurchDate,
         c.c_mktsegment AS Auction,
         n.n_name AS Make,
         p.p_brand AS Model,
         p.p_type AS Size,
         CAST(p.p_size % 12 AS INTEGER) AS VehicleAge,
         CAST(year(o.o_orderdate) - p.p_size % 12 AS INTEGER) AS VehYear,
         CAST(li.sum_c AS DOUBLE) / 100.0::DOUBLE AS VehOdo,
         o.o_totalprice AS VehBCost,
         CAST((2 * li.sum_c + li.n_lines) // (2 * li.n_lines) AS DOUBLE) / 100.0::DOUBLE
           AS MMRAcquisitionAuctionAveragePrice,
         CAST((li.sum_w4 + 50) // 100 AS DOUBLE) / 100.0::DOUBLE AS WarrantyCost
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (
    SELECT l_orderkey,
           min(l_partkey) AS min_partkey,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_c,
           count(*) AS n_lines,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)
                    * CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS sum_w4
    FROM lineitem GROUP BY l_orderkey
  ) li ON o.o_orderkey = li.l_orderkey
  LEFT JOIN part p ON li.min_partkey = p.p_partkey
)"""

EVENTS = """ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(event_type = 'error' AS INTEGER) AS is_error
  FROM events
)"""

DOCS = """docs AS (
  SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""

VIEWS = {"auction": AUCTION, "ev": EVENTS, "docs": DOCS}


def with_views(body: str, *names: str, extra: tuple[str, ...] = ()) -> str:
    """Prefix ``body`` with ``WITH`` clauses for the named views."""
    parts = [VIEWS[n] for n in names] + list(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body
