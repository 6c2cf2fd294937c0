"""Declared schemas of the landing files. Fields that are not listed are never parsed."""

# Field names of the landing documents.
_AMOUNTS = "map<string,string>"

PRICE_BATCH = f"""
batch_info struct<collection_timestamp:string, first_date:string, last_date:string,
                  record_count:bigint, api_source:string>,
records array<struct<date:string, coin_id:string, collection_timestamp:string,
  raw_data:struct<market_data:struct<current_price:{_AMOUNTS}, market_cap:{_AMOUNTS}, total_volume:{_AMOUNTS}>>>>
"""

SERIES_PAYLOAD = (
    "struct<series_id:string, data_points:array<struct<date:string, value:string>>, "
    "count:bigint, start_date:string, end_date:string>"
)

SERIES_BATCH = f"""
batch_info struct<collection_timestamp:string, category:string, start_date:string,
                  end_date:string, series_count:bigint, api_source:string>,
series_data map<string, {SERIES_PAYLOAD}>
"""

MEMPOOL = "count bigint, vsize bigint, total_fee bigint, fee_histogram array<array<double>>"
MEMPOOL_TX = "txid string, fee bigint, vsize bigint, value bigint"
BLOCK = (
    "id string, height bigint, timestamp bigint, tx_count bigint, size bigint, weight bigint, difficulty double"
)
CHAIN_TIP = "height string, hash string, timestamp string"
BLOCK_HEADER = "header string, block_id string"
BLOCK_STATUS = "in_best_chain boolean, height bigint, next_best string"
BLOCK_TX = "txid string, fee bigint, size bigint, weight bigint"
COLLECTION_LOG = (
    "collection_timestamp string, data_types_collected array<string>, collection_status string, error string"
)
