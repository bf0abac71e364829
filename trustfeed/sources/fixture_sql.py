"""SQL text of the source-table mapping, for the DuckDB oracles.

Each oracle query inlines the views it needs as CTEs over the driver tables.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "profile": """
SELECT concat('0x', CAST(c_custkey AS VARCHAR)) AS profile_id,
  c_name AS handle,
  concat('w', CAST(CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR)) AS owned_by,
  concat('s3://img/', CAST(c_custkey AS VARCHAR)) AS profile_picture_s3_url,
  CAST('2022-05-01 00:00:00' AS TIMESTAMP) AS metadata_block_timestamp
FROM customer""",
    "globaltrust": """
SELECT 'followship' AS strategy_name, concat('0x', CAST(c_custkey AS VARCHAR)) AS i,
  (c_acctbal + 1000.0) / 11000.0 AS v, CAST('2024-01-08' AS DATE) AS date FROM customer WHERE c_custkey % 5 <> 4
UNION ALL SELECT 'followship', concat('0x', CAST(c_custkey AS VARCHAR)),
  1.0 - (c_acctbal + 1000.0) / 11000.0, CAST('2024-01-01' AS DATE) FROM customer
UNION ALL SELECT 'engagement', concat('0x', CAST(c_custkey AS VARCHAR)),
  0.5, CAST('2024-02-01' AS DATE) FROM customer""",
    "profile_post": """
SELECT concat('0x', CAST(o_custkey AS VARCHAR), '-0x', CAST(o_orderkey AS VARCHAR)) AS post_id,
  concat('0x', CAST(o_custkey AS VARCHAR)) AS profile_id,
  concat('0x', CAST(o_orderkey AS VARCHAR)) AS contract_publication_id,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN concat('0x', CAST(o_custkey % 50 AS VARCHAR), '-0x', CAST(o_orderkey % 1000 AS VARCHAR)) END AS is_related_to_post,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 1 THEN concat('0x', CAST(o_custkey % 50 AS VARCHAR), '-0x', CAST(o_orderkey % 1000 AS VARCHAR)) END AS is_related_to_comment,
  CASE WHEN o_orderkey % 11 = 0 THEN 'true' ELSE 'false' END AS is_hidden,
  CASE WHEN o_orderkey % 13 = 0 THEN 'true' ELSE 'false' END AS is_gated,
  o_orderdate AS block_timestamp,
  CASE WHEN o_orderkey % 4 = 0 THEN 'es' WHEN o_orderkey % 4 = 1 THEN 'de' ELSE 'en' END AS language,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'US' END AS region,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'NSFW' END AS content_warning,
  CASE WHEN o_orderkey % 3 = 0 THEN 'IMAGE' WHEN o_orderkey % 3 = 1 THEN 'VIDEO' ELSE 'TEXT_ONLY' END AS main_content_focus,
  o_orderpriority AS tags_vector,
  CASE WHEN o_orderkey % 17 = 0 THEN 'true' WHEN o_orderkey % 17 = 1 THEN NULL ELSE 'false' END AS custom_filters_gardener_flagged,
  concat('ipfs://', CAST(o_orderkey AS VARCHAR)) AS content_uri
FROM orders""",
    "publication_stats": """
SELECT concat('0x', CAST(o_custkey AS VARCHAR), '-0x', CAST(o_orderkey AS VARCHAR)) AS publication_id,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS total_amount_of_mirrors,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS total_amount_of_collects,
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS total_amount_of_comments,
  CAST(sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS BIGINT) AS total_upvotes,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS total_downvotes,
  'x' AS datastream_metadata
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderkey""",
    "follower": """
SELECT concat('w', CAST(user_id AS VARCHAR)) AS address, concat('0x', CAST(event_id % 150 AS VARCHAR)) AS follow_profile_id, ts AS block_timestamp
FROM events WHERE event_type = 'signup'""",
    "publication_collect_module_collected_records": """
SELECT event_id AS record_id, concat('0x', CAST(user_id AS VARCHAR), '-0x', CAST(event_id AS VARCHAR)) AS publication_id,
  CAST(event_id % 9 AS VARCHAR) AS collect_publication_nft_id, concat('w', CAST(event_id % 150 AS VARCHAR)) AS collected_by, ts AS block_timestamp
FROM events WHERE event_type = 'purchase'""",
    "post_comment": """
SELECT concat('0x', CAST(conv_id AS VARCHAR), '-0x', CAST(turn AS VARCHAR)) AS comment_id, concat('0x', CAST(conv_id % 40 AS VARCHAR)) AS comment_by_profile_id,
  concat('0x', CAST(turn AS VARCHAR)) AS contract_publication_id, concat('0x', CAST(conv_id AS VARCHAR), '-0x', CAST(conv_id * 3 AS VARCHAR)) AS post_id,
  concat('ipfs://c', CAST(conv_id AS VARCHAR)) AS content_uri, CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS block_timestamp
FROM conversations""",
    "publication_collect_module_details": """
SELECT concat('0x', CAST(o_custkey AS VARCHAR), '-0x', CAST(o_orderkey AS VARCHAR)) AS publication_id,
  CASE WHEN l_linestatus = 'O' THEN CAST(floor(l_extendedprice) AS BIGINT) END AS amount,
  CASE WHEN l_returnflag = 'R' THEN '0x0d500B1d8E8eF31E21C99d1Db9A6444d3ADf1270' ELSE '0xother' END AS currency
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with CTEs for the named views (in the given order), then
    any extra (name, sql) CTEs that may refer to them."""
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in names]
    ctes += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
