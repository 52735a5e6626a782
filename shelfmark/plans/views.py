"""Stand-in flyer, master, box and model answer tables over the star schema's tables. The same SQL runs in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.sources.work import spread

MASTER = """
SELECT p_partkey AS master_row,
  CASE WHEN p_partkey % 2 = 0 THEN upper(concat(p_name, ' ', p_type))
    ELSE concat(substr(upper(p_name), 1, 1), translate(substr(upper(p_name), 2), 'AEIOU', ''), ' ', p_type) END AS Description,
  concat(CAST(p_size AS STRING), ' oz') AS Size,
  CASE WHEN p_partkey % 4 = 0 THEN 'nan' ELSE concat(CAST(p_partkey % 12 + 1 AS STRING), ' pk') END AS Pack,
  CAST(p_partkey % 3 + 1 AS STRING) AS Retail_Factor, concat('$', CAST(p_retailprice AS STRING)) AS Retail_Amt,
  p_type AS nCat_Desc, p_brand AS BRAND FROM {part}"""

#: Every part as a flyer would print it; the flyer table lists every fiftieth.
PRINTED = """
SELECT p_partkey AS flyer_row, concat(upper(substr(p_name, 1, 1)), substr(p_name, 2), ' ', lower(p_type)) AS Description,
  CASE WHEN p_partkey % 100 = 0 THEN concat('1-', CAST(p_size AS STRING), ' oz') ELSE concat(CAST(p_size AS STRING), ' oz') END AS Size,
  CASE WHEN p_partkey % 3 = 0 THEN 'null' ELSE concat(CAST(p_partkey % 12 + 1 AS STRING), ' pk') END AS Pack,
  CAST(p_partkey % 3 + 1 AS STRING) AS Retail_Factor,
  concat('$', CAST(CASE WHEN p_partkey % 150 = 0 THEN p_retailprice + 5 ELSE p_retailprice END AS STRING)) AS Retail_Amt,
  CAST(p_partkey % 7 + 1 AS INT) AS Page_Number FROM {part}"""
FLYER = PRINTED + " WHERE p_partkey % 50 = 0"

#: A flyer of which every second item is none of the catalogue's, and some are like nothing in it.
FLYER_ODD = """
SELECT flyer_row, CASE WHEN flyer_row % 200 = 0 THEN concat('~ ', CAST(flyer_row AS STRING)) WHEN flyer_row % 100 = 0 THEN concat('Imported offer ', Description, ' of the week ', CAST(flyer_row AS STRING))
  ELSE Description END AS Description, Size, Pack, Retail_Factor, Retail_Amt, Page_Number FROM (""" + FLYER + ")"

BOXES = """
SELECT concat('flyer_page_', CAST(l_orderkey AS STRING), '.jpg') AS image_name, l_linenumber AS box_idx,
  l_quantity * 30 - 60 AS x1, l_discount * 15000 - 30 AS y1, l_quantity * 30 - 60 + l_tax * 1000 AS x2, l_discount * 15000 - 30 + l_tax * 800 AS y2,
  1280 AS img_w, 1400 AS img_h FROM {lineitem}"""

RESPONSES = """
SELECT p_partkey AS image_row, concat('flyer_page_', CAST(p_partkey % 7 + 1 AS STRING), '_crop_', CAST(p_partkey AS STRING), '.jpg') AS image_name,
  CASE WHEN p_partkey % 11 = 0 THEN 'not json' ELSE concat('{{"clusters":[{{"label":', CAST(p_partkey % 4 + 1 AS STRING), '}}]}}') END AS label_json,
  concat('{{"extracted_data":[{{"Size":"', CAST(p_size AS STRING), '  oz","Pack":"null","RetailAmount":"$', CAST(p_retailprice AS STRING),
    '","RetailFactor":"1","Description":" ', p_name, ' ","Ad":"null"}}',
    CASE WHEN p_partkey % 13 = 0 THEN ',{{"Size":"","Pack":"null","RetailAmount":"NULL","RetailFactor":"","Description":"null","Ad":""}}' ELSE '' END, ']}}') AS items_json FROM {part}"""


def view(spark: SparkSession, sf_dir: str, sql: str, dealt: bool = False) -> DataFrame:
    """The rows of one of the views; `dealt` to all tasks before the view's texts are made, for more work than the tables' few bytes tell."""
    names = [t for t in ("part", "lineitem") if f"{{{t}}}" in sql]
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}
    return spark.sql(sql, **{t: spread(df) if dealt else df for t, df in read.items()})


def duck(sql: str) -> str:
    return sql.format(part="part", lineitem="lineitem")
