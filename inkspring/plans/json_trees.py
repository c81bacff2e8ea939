"""Rules on JSON documents that are made for every customer: schemas to strip, configurations to check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.operators import trees as T
from inkspring.registry import query, table


@query("F14_schema_without_proofs", oracle="""SELECT c_custkey, to_json(CASE WHEN c_custkey % 3 = 0
THEN {'anyOf': ['{}'::JSON, '{"type":"null"}'::JSON], 'properties': to_json({'kind': {'type': 'string'}, 'name': {'maxLength': length(c_name), 'type': 'string'}}), 'required': ['name', c_mktsegment], 'type': 'object'}
ELSE {'anyOf': ['{}'::JSON, '{"type":"null"}'::JSON], 'properties': to_json({'kind': {'type': 'string'}, 'name': {'maxLength': length(c_name), 'type': 'string'}, 'nested': {'items': {'required': []::VARCHAR[], 'type': 'object'}, 'type': 'array'}}), 'required': ['name', c_mktsegment], 'type': 'object'} END)::VARCHAR AS json FROM customer""")
def schema_without_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas that name the values of a customer, without enumerations and without citations that are required."""
    c = table(spark, sf_dir, "customer")
    text = lambda s: F.lit(s)
    nested = text('"nested":{"type":"array","items":{"type":"object","enum":["a",{"enum":1}],"required":["evidence_refs"]}},')
    doc = F.concat(
        text('{"type":"object","required":["name","evidence_refs","'), "c_mktsegment", text('"],"properties":{'), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(nested),
        text('"kind":{"enum":["'), "c_mktsegment", text('","other"],"type":"string"},"name":{"type":"string","maxLength":'), F.char_length("c_name").cast("string"), text('}},"anyOf":[{"enum":[1,null,{"a":[]}]},{"type":"null"}]}'),
    )
    return T.without_proofs(c.select("c_custkey", F.parse_json(doc).alias("doc")), "c_custkey")


RULES = [
    T.Rule("/mode", ("string",), choices=('"BUILDING"', '"MACHINERY"', '"HOUSEHOLD"')), T.Rule("/enabled", ("boolean",)), T.Rule("/font/min", ("number",), 1, 256, whole=True), T.Rule("/font/max", ("number",), 1, 256, whole=True),
    T.Rule("/spacing", ("number",), 1, 2), T.Rule("/overlap", ("number",), high=1, above=0), T.Rule("/path", ("string", "null")),
]


@query("F19_config_violations", oracle="""WITH c AS (SELECT c_custkey, c_custkey % 10 AS k, c_mktsegment, c_custkey % 300 AS small, 40 + c_custkey % 9 AS large, (c_custkey % 25) / 10.0 AS spacing, (c_custkey % 13) / 10.0 AS overlap FROM customer)
SELECT c_custkey, '/mode' AS path, 'not_allowed' AS code FROM c WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
UNION ALL SELECT c_custkey, '/enabled', 'wrong_type' FROM c WHERE k = 3
UNION ALL SELECT c_custkey, '/font/min', 'out_of_range' FROM c WHERE k <> 4 AND (small < 1 OR small > 256)
UNION ALL SELECT c_custkey, '/font/min', 'wrong_type' FROM c WHERE k = 4
UNION ALL SELECT c_custkey, '/font/min', 'wrong_order' FROM c WHERE k <> 4 AND small > large OR k = 4 AND small + 0.5 > large
UNION ALL SELECT c_custkey, '/spacing', 'out_of_range' FROM c WHERE k <> 5 AND (spacing < 1 OR spacing > 2)
UNION ALL SELECT c_custkey, '/spacing', 'missing_field' FROM c WHERE k = 5
UNION ALL SELECT c_custkey, '/overlap', 'out_of_range' FROM c WHERE overlap <= 0 OR overlap > 1
UNION ALL SELECT c_custkey, '/extra', 'unknown_field' FROM c WHERE k = 6
UNION ALL SELECT c_custkey, '/path', 'wrong_type' FROM c WHERE k = 7""")
def config_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything wrong with the configuration of every customer, field by field."""
    k = F.col("c_custkey") % 10
    number = lambda n, of: F.format_number((F.col("c_custkey") % n) / of, 1)
    doc = F.concat(
        F.lit('{"mode":"'), "c_mktsegment", F.lit('","enabled":'), F.when(k == 3, '"yes"').otherwise("true"), F.lit(',"font":{"min":'), (F.col("c_custkey") % 300).cast("string"), F.when(k == 4, ".5").otherwise(""), F.lit(',"max":'), (40 + F.col("c_custkey") % 9).cast("string"), F.lit("},"),
        F.when(k == 5, "").otherwise(F.concat(F.lit('"spacing":'), number(25, 10), F.lit(","))), F.lit('"overlap":'), number(13, 10), F.when(k == 6, ',"extra":{"a":[1]}').otherwise(""), F.when(k == 7, ',"path":["x"]}').otherwise(',"path":null}'),
    )
    return T.violations(table(spark, sf_dir, "customer").select("c_custkey", F.parse_json(doc).alias("doc")), "c_custkey", RULES, [("/font/min", "/font/max")])
