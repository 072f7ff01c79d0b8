"""Common table expressions of the check SQL, by view name."""

from __future__ import annotations

TRANSACTIONS = """
tx AS (
  SELECT o_custkey AS CustomerID, o_orderdate AS InvoiceDate,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS Quantity,
         l_extendedprice / l_quantity AS UnitPrice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sales AS (
  SELECT *, Quantity * UnitPrice AS Sales FROM tx WHERE Quantity > 0 AND UnitPrice >= 0)"""

RFM = TRANSACTIONS + """,
per_customer AS (
  SELECT CustomerID, max(CAST(InvoiceDate AS DATE)) AS LastDay, count(*) AS Frequency, sum(Sales) AS Monetary
  FROM sales GROUP BY CustomerID),
rfm AS (
  SELECT CustomerID,
         date_diff('day', LastDay, (SELECT max(LastDay) FROM per_customer) + 1) AS Recency,
         Frequency, Monetary
  FROM per_customer)"""

CLUSTERED = RFM + """,
clustered AS (SELECT *, CustomerID % 4 AS Cluster FROM rfm),
overall AS (SELECT median(Recency) AS r, median(Frequency) AS f, median(Monetary) AS m FROM rfm),
means AS (
  SELECT Cluster, count(*) AS Customers,
         round_even(avg(Recency), 2) AS AvgRecency, round_even(median(Recency), 2) AS MedianRecency,
         round_even(avg(Frequency), 2) AS AvgFrequency, round_even(median(Frequency), 2) AS MedianFrequency,
         round_even(avg(Monetary), 2) AS AvgMonetary, round_even(median(Monetary), 2) AS MedianMonetary
  FROM clustered GROUP BY Cluster),
named AS (
  SELECT means.*, {segment} AS Name FROM means, overall),
profile AS (
  SELECT * EXCLUDE (Name),
         CASE WHEN count(*) OVER (PARTITION BY Name) > 1
              THEN Name || ' (Cluster ' || Cluster || ')' ELSE Name END AS Segment
  FROM named)"""


def segment_case(r: str, f: str, m: str) -> str:
    recent, frequent, high = f"{r} <= r", f"{f} >= f", f"{m} >= m"
    return f"""CASE
      WHEN {recent} AND {frequent} AND {high} THEN 'Champions / High Value'
      WHEN NOT {recent} AND {frequent} AND {high} THEN 'At-Risk High Value'
      WHEN {recent} AND NOT {frequent} THEN 'Recent / New Customers'
      WHEN {frequent} THEN 'Regular Customers'
      WHEN NOT {recent} AND NOT {high} THEN 'Dormant / Low Engagement'
      ELSE 'Occasional Customers' END"""


CLUSTERED = CLUSTERED.format(segment=segment_case("MedianRecency", "MedianFrequency", "MedianMonetary"))


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"
